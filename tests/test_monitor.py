from datetime import datetime

from helpers import envelope_row, rows, txn

from txnflow.operators.monitor import (
    consumer_lag,
    end_offsets,
    latest_commits,
    latest_messages,
    topic_high_water,
)
from txnflow.schemas import ENVELOPE
from txnflow.sources.textlogs import batch_commits, produced_count

LINES = [
    "2024-05-01 10:00:00 | INFO | consumer | [raw_graph] batch=7 rows=42",
    "2024-05-01 10:00:00 | INFO | consumer | [raw_graph] batch=8 empty",
    "2024-05-01 10:00:00 | INFO | consumer | [category_stats]  batch=3 rows=0",
    "2024-05-01 10:00:00 | INFO | producer | produced 150 transactions (last id=150)",
    "produced 50 transactions, produced  900 transactions",
    "produced many transactions",
    "",
]


def lines(spark, values=LINES):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_batch_commits(spark):
    commits = batch_commits(lines(spark))
    assert rows(commits.drop("logged_at")) == [("category_stats", 3, 0), ("raw_graph", 7, 42)]
    assert [tuple(r) for r in latest_commits(commits, 1).collect()] == [
        ("category_stats", 3, 0, datetime(2024, 5, 1, 10))]


def test_latest_commits_follow_the_clock(spark):
    logged = [f"2024-05-01 10:00:{i:02d} | INFO | consumer | [raw_graph] batch={500 + i} rows=1" for i in range(20)]
    logged += ["2024-05-01 11:00:00 | INFO | consumer | [category_stats] batch=3 rows=2", "[raw_graph] batch=9999 rows=1"]
    newest = latest_commits(batch_commits(lines(spark, logged)), 12).collect()
    assert [(r["sink"], r["batch"]) for r in newest[:2]] == [("category_stats", 3), ("raw_graph", 519)]
    assert all(r["batch"] != 9999 for r in newest)


def test_produced_count(spark):
    assert rows(produced_count(lines(spark))) == [(900,)]
    assert rows(produced_count(lines(spark, ["x"]))) == [(0,)]
    assert rows(produced_count(lines(spark).limit(0))) == [(0,)]


def topic(spark):
    return spark.createDataFrame(
        [envelope_row(txn(i, "10:00:00", amount=i), offset=i // 2, partition=i % 2) for i in range(7)], ENVELOPE)


def test_offsets(spark):
    assert rows(end_offsets(topic(spark))) == [(0, 4), (1, 3)]
    assert rows(topic_high_water(topic(spark))) == [(7,)]
    assert rows(topic_high_water(topic(spark).limit(0))) == [(0,)]
    committed = spark.createDataFrame([(0, 1)], "partition INT, end_offset BIGINT")
    assert rows(consumer_lag(topic(spark), committed)) == [(0, 3), (1, 3)]
    ahead = spark.createDataFrame([(0, 99), (1, 3)], "partition INT, end_offset BIGINT")
    assert rows(consumer_lag(topic(spark), ahead)) == [(0, 0), (1, 0)]
    gone = spark.createDataFrame([(0, 4), (2, 7)], "partition INT, end_offset BIGINT")
    assert rows(consumer_lag(topic(spark), gone)) == [(0, 0), (1, 3), (2, 0)]
    assert rows(topic_high_water(topic(spark), gone)) == [(14,)]


def test_latest_messages(spark):
    found = latest_messages(topic(spark), 3).collect()
    assert [(r["partition"], r["offset"], r["transaction_id"]) for r in found] == [(1, 2, 5), (1, 1, 3), (1, 0, 1)]
