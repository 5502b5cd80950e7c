import logging
import re
import time

import pytest
from helpers import DAY, envelope, land, merchants, rows, txn
from pyspark.sql import functions as F

from txnflow.operators.filters import parse_approved
from txnflow.operators.stats import category_stats_of, stats_payload
from txnflow.session import streaming_session, work_folder
from txnflow.sources.textlogs import batch_commits, stream_log
from txnflow.sources.topics import file_batch, file_stream
from txnflow.streaming.pipeline import (
    PipelineConfig,
    frozen,
    start_category_stats,
    start_ingest,
    start_pipeline,
    start_raw_graph,
)
from txnflow.streaming.progress import committed_offsets, progress_frame, progress_rows
from txnflow.streaming.store import GraphStore

ONCE = {"availableNow": True}


class Feed:
    """A topic folder, a store and checkpoints; each step lands one file and runs what is new."""

    def __init__(self, spark, state_store="default", **settings):
        self.session = streaming_session(spark, state_store)
        self.session.conf.set("spark.sql.shuffle.partitions", "2")
        self.work = work_folder(spark, "feed")
        self.topic = f"{self.work}/topic"
        self.store = GraphStore(self.session, f"{self.work}/store")
        self.config = PipelineConfig(checkpoint_root=f"{self.work}/checkpoints", **settings)
        self.merchants = merchants(spark)
        self.queries = []

    def stats(self, *messages):
        """Rows this step emitted: (minute, total, count)."""
        known = set(self.store.stats.batches())
        if messages:
            land(self.session, self.topic, messages)
        query = start_category_stats(
            file_stream(self.session, self.topic), self.merchants, self.store, self.config, ONCE
        )
        query.awaitTermination()
        self.queries.append(query)
        new = [b for b in self.store.stats.batches() if b not in known]
        emitted = self.store.stats.read().where(
            F.struct("run_seq", "batch_id").isin([F.struct(F.lit(r), F.lit(b).cast("long")) for r, b in new])
        ) if new else self.store.stats.read().limit(0)
        return rows(emitted, F.date_format("window_start", "HH:mm"), "total_amount", "txn_count")

    def raw(self, *messages):
        if messages:
            land(self.session, self.topic, messages)
        query = start_raw_graph(file_stream(self.session, self.topic), self.store, self.config, ONCE)
        query.awaitTermination()
        return query

    def dropped(self):
        return sum(r[3] for r in progress_rows(self.queries[-1]))


@pytest.mark.parametrize("state_store", ["default", "rocksdb"])
def test_late_rows(spark, state_store):
    feed = Feed(spark, state_store)
    assert feed.stats(txn(1, "00:00:10", 1.0), txn(2, "00:00:20", 2.0)) == [("00:00", 3.0, 2)]
    assert feed.stats(txn(3, "00:10:00", 1.0)) == [("00:10", 1.0, 1)]
    # The end of a run moves the watermark on, so a window closed by an earlier run is late at once.
    assert feed.stats(txn(4, "00:00:30", 100.0), txn(5, "00:10:30", 1.0)) == [("00:10", 2.0, 2)]
    assert feed.dropped() == 1
    assert feed.stats(txn(6, "00:09:59", 7.0), txn(7, "00:20:00", 1.0)) == [("00:09", 7.0, 1), ("00:20", 1.0, 1)]
    assert feed.dropped() == 0


def test_late_filter_follows_the_previous_batch_within_a_run(spark):
    """Without a pause between batches a window closed by the last batch still takes rows."""
    feed = Feed(spark)
    steps = [
        [txn(1, "00:00:10", 1.0), txn(2, "00:00:20", 2.0)], [txn(3, "00:10:00", 1.0)],
        [txn(4, "00:00:30", 100.0), txn(5, "00:10:30", 1.0)], [txn(6, "00:00:40", 1000.0), txn(7, "00:10:40", 1.0)],
        [txn(8, "00:20:00", 1.0)],
    ]
    for step in steps:
        land(feed.session, feed.topic, step)
        time.sleep(1.1)
    query = start_category_stats(
        file_stream(feed.session, feed.topic, max_files_per_trigger=1), feed.merchants, feed.store, feed.config, ONCE
    )
    query.awaitTermination()
    emitted = rows(
        feed.store.stats.read(), "batch_id", F.date_format("window_start", "HH:mm"), "total_amount", "txn_count"
    )
    assert emitted == [
        (0, "00:00", 3.0, 2), (1, "00:10", 1.0, 1), (2, "00:00", 103.0, 3), (2, "00:10", 2.0, 2),
        (3, "00:10", 3.0, 3), (4, "00:20", 1.0, 1),
    ]
    dropped = [r[3] for r in progress_rows(query)]
    assert sum(dropped) == 1 and dropped[3] == 1


def test_update_mode_overwrites_running_totals(spark):
    feed = Feed(spark)
    assert feed.stats(txn(1, "00:00:10", 10.0)) == [("00:00", 10.0, 1)]
    assert feed.stats(txn(2, "00:00:20", 11.0)) == [("00:00", 21.0, 2)]
    assert feed.stats(txn(3, "00:00:30", 0.5), txn(4, "00:01:10", 1.0)) == [("00:00", 21.5, 3), ("00:01", 1.0, 1)]
    current = rows(feed.store.category_stats(), "category", "country", "total_amount", "txn_count")
    assert current == [("travel", "Spain", 1.0, 1), ("travel", "Spain", 21.5, 3)]


def test_declined_rows_do_not_move_the_watermark(spark):
    feed = Feed(spark)
    feed.stats(txn(1, "00:00:10"), txn(2, "09:00:00", status="declined"), txn(3, "09:00:00", status="pending"))
    assert feed.stats(txn(4, "00:00:20")) == [("00:00", 2.0, 2)]
    marks = {r[2] for q in feed.queries for r in progress_rows(q)}
    assert not any(mark and mark > f"{DAY}08" for mark in marks)


def test_null_country_is_a_group_and_repeats_count_twice(spark):
    feed = Feed(spark)
    feed.stats(txn(1, "00:00:10", country=None), txn(1, "00:00:10", country=None), txn(2, "00:00:10", merchant=9))
    feed.stats(txn(3, "00:00:20", country=None))
    assert rows(feed.store.category_stats(), "country", "total_amount", "txn_count") == [(None, 3.0, 3)]


def test_repeats_can_be_dropped_from_the_window_path(spark):
    feed = Feed(spark, dedup_window_path=True)
    feed.stats(txn(1, "00:00:10"), txn(1, "00:00:10"), txn(2, "00:00:20"))
    feed.stats(txn(1, "00:00:10"), txn(3, "00:00:30"))
    assert rows(feed.store.category_stats(), "total_amount", "txn_count") == [(3.0, 3)]


def test_append_mode_emits_closed_windows_only(spark):
    feed = Feed(spark, stats_mode="append")
    assert feed.stats(txn(1, "00:00:10"), txn(2, "00:00:20")) == []
    assert feed.stats(txn(3, "00:05:00")) == [("00:00", 2.0, 2)]


def test_salted_join_in_a_stream(spark):
    feed = Feed(spark, join_strategy="salted")
    feed.stats(*(txn(i, "00:00:10") for i in range(40)), txn(41, "00:00:10", merchant=2), txn(42, "00:00:10", merchant=3))
    assert rows(feed.store.category_stats(), "category", "txn_count") == [("health", 1), ("travel", 40)]


def test_stream_equals_table_under_any_arrival_order(spark):
    messages = [txn(i, f"00:00:{i:02d}", i / 4, merchant=1 + i % 3) for i in range(48)]
    feed = Feed(spark)
    order = sorted(messages, key=lambda m: (m["transaction_id"] * 29) % 48)
    for i in range(0, 48, 16):
        feed.stats(*order[i:i + 16])
    batch = category_stats_of(parse_approved(envelope(spark, messages)), merchants(spark))
    assert rows(stats_payload(feed.store.category_stats())) == rows(stats_payload(batch))


def test_raw_sink_stores_late_rows_and_ignores_later_duplicates(spark):
    feed = Feed(spark)
    feed.raw(txn(1, "00:00:10", 5.0), txn(1, "00:00:09", 6.0), txn(2, "05:00:00", 1.0))
    feed.raw(txn(1, "00:00:01", 7.0), txn(3, "00:00:01", 1.0), txn(4, "00:00:01", status="declined"))
    graph = feed.store.graph()
    assert rows(graph.transactions, "transaction_id", "amount") == [(1, 6.0), (2, 1.0), (3, 1.0)]


def test_reused_id_of_another_customer_adds_an_edge_but_no_node(spark):
    feed = Feed(spark)
    feed.raw(txn(1, "00:00:10", 5.0, customer=1))
    feed.raw(txn(1, "00:00:20", 9.0, customer=2, merchant=7))
    graph = feed.store.graph()
    assert rows(graph.transactions, "transaction_id", "amount") == [(1, 5.0)]
    assert rows(graph.made, "customer_id", "transaction_id", "amount") == [(1, 1, 5.0), (2, 1, 9.0)]
    assert rows(graph.at) == [(1, 1), (1, 7)]


def test_rejects_are_kept_apart(spark):
    feed = Feed(spark)
    feed.raw(txn(1, "00:00:10"), txn(None, "00:00:10"), txn(None, "00:00:11"), txn(3, "never"))
    assert rows(feed.store.graph().transactions, "transaction_id") == [(1,)]
    assert rows(feed.store.rejects.read(), "transaction_id") == [(3,), (None,), (None,)]
    feed.raw(txn(5, "00:00:10"))
    assert feed.store.rejects.batches() == [(0, 0)]


def test_replayed_batch_replaces_itself(spark):
    from txnflow.streaming.sinks import category_stats_writer, raw_graph_writer

    feed = Feed(spark)
    feed.raw(txn(1, "00:00:10"), txn(2, "00:00:20"))
    feed.stats()
    before = (rows(feed.store.raw.read()), rows(feed.store.category_stats(), "total_amount", "txn_count"))
    batch = parse_approved(file_batch(feed.session, feed.topic))
    raw_graph_writer(feed.store, 0)(batch, 0)
    category_stats_writer(feed.store, 0)(category_stats_of(batch, feed.merchants), 0)
    after = (rows(feed.store.raw.read()), rows(feed.store.category_stats(), "total_amount", "txn_count"))
    assert after == before


def test_restart_goes_on_and_a_fresh_checkpoint_does_not_overwrite(spark):
    feed = Feed(spark)
    feed.raw(txn(1, "00:00:10", 1.0))
    feed.raw()
    feed.raw(txn(2, "00:00:20", 2.0))
    assert feed.store.raw.batches() == [(0, 0), (0, 1)]
    fresh = PipelineConfig(checkpoint_root=f"{feed.work}/fresh")
    start_raw_graph(file_stream(feed.session, feed.topic), feed.store, fresh, ONCE).awaitTermination()
    assert feed.store.raw.batches() == [(0, 0), (0, 1), (1, 0)]
    assert rows(feed.store.graph().transactions, "transaction_id", "amount") == [(1, 1.0), (2, 2.0)]


def test_both_sinks_of_one_source(spark, caplog):
    feed = Feed(spark)
    feed.store.seed_merchants(
        feed.session.createDataFrame([(1, "Shop", "travel", "Spain", "Madrid")],
                                     "merchant_id INT, merchant_name STRING, category STRING, "
                                     "merchant_country STRING, merchant_city STRING")
    )
    land(feed.session, feed.topic, [txn(1, "00:00:10"), txn(2, "00:00:40"), txn(3, "00:00:40", merchant=9)])
    with caplog.at_level(logging.INFO, logger="txnflow.consumer"):
        queries = start_pipeline(file_stream(feed.session, feed.topic), feed.store, feed.config, trigger=ONCE)
        for query in queries:
            query.awaitTermination()
    assert [q.name for q in queries] == ["raw_graph_sink", "category_stats_sink"]
    assert feed.store.graph().transactions.count() == 3
    assert rows(feed.store.category_stats(), "category", "txn_count") == [("travel", 2)]
    lines = [r.getMessage() for r in caplog.records]
    assert "[raw_graph] batch=0 rows=3" in lines and "[category_stats] batch=0 rows=1" in lines
    assert any(re.fullmatch(r"\[category_stats\] batch=\d+ empty", line) for line in lines)


def test_frozen_dimension(spark):
    feed = Feed(spark)
    feed.merchants = frozen(feed.merchants)
    assert feed.stats(txn(1, "00:00:10")) == [("00:00", 1.0, 1)]
    assert feed.merchants.storageLevel.useDisk
    feed.merchants.unpersist()


def test_ingest(spark):
    feed = Feed(spark)
    for i in range(2):
        land(feed.session, feed.topic, [txn(i, "00:00:10"), None])
        start_ingest(
            file_stream(feed.session, feed.topic, max_bytes_per_trigger=1 << 30), f"{feed.work}/in", f"{feed.work}/cp", ONCE
        ).awaitTermination()
    assert file_batch(feed.session, f"{feed.work}/in").count() == 4


def test_progress_rows_and_offsets_of_files(spark):
    feed = Feed(spark)
    feed.stats(txn(1, "00:00:10"), txn(2, "00:00:20", status="pending"))
    frame = progress_frame(spark, progress_rows(feed.queries[-1]))
    assert frame.columns == ["batch", "input_rows", "watermark", "dropped_rows", "state_rows"]
    assert rows(frame, "batch", "input_rows")[0] == (0, 2)
    assert committed_offsets(spark, feed.queries[-1], "transactions").count() == 0


def test_log_lines_as_a_stream(spark):
    work = work_folder(spark, "lines")
    spark.createDataFrame([("t | [raw_graph] batch=7 rows=42",), ("t | [raw_graph] batch=8 empty",)], "value STRING") \
        .write.text(f"{work}/logs")
    query = (
        batch_commits(stream_log(spark, f"{work}/logs")).writeStream.format("parquet")
        .option("path", f"{work}/out").option("checkpointLocation", f"{work}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{work}/out")) == [("raw_graph", 7, 42, None)]
