"""Logged progress reports, stored topics and the publisher's report."""

import json
import logging
import re

from helpers import envelope_row, land, merchants, rows, txn
from pyspark.sql import functions as F

from txnflow.functions.messages import parse_transactions
from txnflow.operators import monitor
from txnflow.schemas import ENVELOPE
from txnflow.session import streaming_session, work_folder, write_text
from txnflow.sources import topics
from txnflow.sources.textlogs import produced_count, read_log
from txnflow.streaming.pipeline import PipelineConfig, start_category_stats
from txnflow.streaming.progress import ProgressLog, logged_offsets, read_progress
from txnflow.streaming.publisher import ProducerReport, publish_transactions
from txnflow.streaming.store import GraphStore

ONCE = {"availableNow": True}


def test_no_report_is_lost_where_spark_keeps_two(spark):
    session, work = streaming_session(spark, "default"), work_folder(spark, "progress")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = ProgressLog(session, f"{work}/reports").attach()
    for minute in range(5):
        land(session, f"{work}/topic", [txn(minute, f"00:0{minute}:00"), txn(100 + minute, f"00:0{minute}:30")])
    stream = topics.file_stream(session, f"{work}/topic", max_files_per_trigger=1)
    config = PipelineConfig(checkpoint_root=f"{work}/checkpoints")
    query = start_category_stats(stream, merchants(session), GraphStore(session, f"{work}/store"), config, ONCE)
    query.awaitTermination()
    log.wait(query)
    log.detach()
    assert len(query.recentProgress) <= 2
    found = read_progress(spark, f"{work}/reports")
    assert {r["run_id"] for r in found.collect()} == {str(query.runId)}
    assert rows(found.where("input_rows > 0"), "batch", "input_rows") == [(i, 2) for i in range(5)]
    assert found.where("state_rows > 0 and watermark is not null and reported_at is not null").count() >= 4


def test_progress_of_nothing(spark):
    assert rows(read_progress(spark, work_folder(spark, "none"))) == []


def test_offsets_from_logged_reports(spark):
    folder = work_folder(spark, "reports")
    for batch, ends in enumerate(({"0": 5, "1": 7}, {"0": 9, "1": 7})):
        report = {"id": "q", "runId": "r", "batchId": batch, "numInputRows": 1, "sources": [
            {"description": "Kafka", "endOffset": {"t": ends}}, {"description": "Files", "endOffset": {"logOffset": 3}}]}
        write_text(spark, f"{folder}/q-r-{batch}.json", json.dumps(report))
    found = read_progress(spark, folder)
    assert rows(logged_offsets(found, "t")) == [(0, 9), (1, 7)]
    assert topics.tail_starts(logged_offsets(found, "t"), 8) == {0: 1, 1: 0}


def stored(spark):
    folder = work_folder(spark, "topic")
    for part in range(4):
        messages = [envelope_row(txn(i, "10:00:00", amount=i), offset=i // 2, partition=i % 2) for i in range(50 * part, 50 * part + 50)]
        topics.store_topic(spark.createDataFrame(messages, ENVELOPE), folder)
    return folder


def test_bounds_come_from_footers(spark):
    ends = topics.stored_end_offsets(spark, stored(spark))
    plan = ends._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(offset)]" in plan and "PushedGroupBy: [partition]" in plan
    assert "value" not in re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert rows(ends) == [(0, 100), (1, 100)]
    assert rows(monitor.high_water(ends)) == [(200,)]
    committed = spark.createDataFrame([(0, 90)], "partition INT, end_offset BIGINT")
    assert rows(monitor.lag_behind(ends, committed)) == [(0, 10), (1, 100)]


def test_a_tail_opens_the_end_only(spark):
    tail = topics.stored_tail(spark, stored(spark), 5)
    assert "GreaterThanOrEqual(offset,95)" in tail._jdf.queryExecution().executedPlan().toString()
    assert rows(tail, "partition", "offset") == [(p, o) for p in (0, 1) for o in range(95, 100)]
    newest = monitor.latest_messages(tail, 3).collect()
    assert [(r["partition"], r["offset"]) for r in newest] == [(1, 99), (1, 98), (1, 97)]
    assert newest[0]["transaction_id"] == 199


def test_published_transactions_are_reported(spark, caplog):
    session, work = streaming_session(spark, "default"), work_folder(spark, "publish")
    report = ProducerReport(session, f"{work}/log").attach()
    with caplog.at_level(logging.INFO, logger="txnflow.producer"):
        for first in (0, 10):
            land(session, f"{work}/topic", [txn(i, "00:00:10") for i in range(first, first + 10)])
            query = publish_transactions(
                parse_transactions(topics.file_stream(session, f"{work}/topic")), f"{work}/cp", {"path": f"{work}/out"},
                sink="parquet", trigger=ONCE,
            )
            query.awaitTermination()
            report.wait(query)
    report.detach()
    assert [r.getMessage() for r in caplog.records] == [
        "produced 10 transactions (last id=9)", "produced 20 transactions (last id=19)"]
    assert rows(produced_count(read_log(spark, f"{work}/log"))) == [(20,)]
    assert spark.read.parquet(f"{work}/out").select(F.col("key").cast("string")).distinct().count() == 20
