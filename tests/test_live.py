"""Statistics whose merchants are looked up batch by batch, as they are seeded then."""

import pytest
from helpers import land, rows, txn

from txnflow.session import streaming_session, work_folder
from txnflow.sources.topics import file_stream
from txnflow.streaming.pipeline import PipelineConfig, start_category_stats, start_merchant_stats
from txnflow.streaming.sinks import merchant_stats_writer
from txnflow.streaming.store import GraphStore

ONCE = {"availableNow": True}
SEED = "merchant_id BIGINT, category STRING"


class Live:
    def __init__(self, spark, **settings):
        self.spark, self.session = spark, streaming_session(spark, "default")
        self.session.conf.set("spark.sql.shuffle.partitions", "2")
        self.work = work_folder(spark, "live")
        self.store = GraphStore(self.session, f"{self.work}/store")
        self.settings = settings

    def seed(self, *pairs):
        self.store.seed_merchants(self.session.createDataFrame(list(pairs), SEED), ("category",))

    def run(self, *messages, checkpoint="checkpoints", writer=None):
        if messages:
            land(self.session, f"{self.work}/topic", messages)
        config = PipelineConfig(checkpoint_root=f"{self.work}/{checkpoint}", **self.settings)
        stream = file_stream(self.session, f"{self.work}/topic")
        query = start_merchant_stats(stream, self.store, config, ONCE, writer=writer)
        query.awaitTermination()
        return self.totals()

    def totals(self):
        return rows(self.store.category_stats(), "category", "country", "total_amount", "txn_count")


def test_merchants_seeded_later_count_from_the_next_batch(spark):
    live = Live(spark)
    live.seed((1, "travel"))
    assert live.run(txn(1, "00:00:10", 5.0), txn(2, "00:00:10", 7.0, merchant=2)) == [("travel", "Spain", 5.0, 1)]
    live.seed((2, "health"))
    # What merchant 2 took in before it was known stays without a category.
    want = [("health", "Spain", 1.0, 1), ("travel", "Spain", 5.25, 2)]
    assert live.run(txn(3, "00:00:20", 1.0, merchant=2), txn(4, "00:00:20", 0.25)) == want


def test_a_new_category_takes_what_comes_after_it(spark):
    live = Live(spark)
    live.seed((1, "travel"), (3, "travel"))
    live.run(txn(1, "00:00:10", 5.1), txn(2, "00:00:11", 2.2, merchant=3))
    live.seed((1, "health"))
    live.run(txn(3, "00:00:20", 0.3), txn(4, "00:00:21", 1.1, merchant=3))
    live.seed((1, "travel"))
    want = [("health", "Spain", 0.3, 1), ("travel", "Spain", 12.4, 4)]
    assert live.run(txn(5, "00:00:30", 4.0)) == want
    live.store.compact_stats(upto=(0, 99))
    assert live.totals() == want
    # The folded rows go on as the base of later batches.
    assert live.run(txn(6, "00:00:40", 1.0)) == [want[0], ("travel", "Spain", 13.4, 5)]
    live.store.compact_stats()
    live.store.expire("merchant_stats")
    assert live.totals() == [want[0], ("travel", "Spain", 13.4, 5)]


def test_a_replayed_batch_takes_the_dimension_it_took_before(spark):
    live = Live(spark)
    live.seed((1, "travel"))
    kept = []

    def writer(batch, batch_id):
        kept.append((batch.persist(), batch_id))
        merchant_stats_writer(live.store, 0)(batch, batch_id)

    before = live.run(txn(1, "00:00:10", 5.0), writer=writer)
    live.seed((1, "health"))
    merchant_stats_writer(live.store, 0)(*kept[0])
    assert live.totals() == before == [("travel", "Spain", 5.0, 1)]


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_the_dimension_is_measured_per_version(spark, limit):
    live = Live(spark)
    live.seed((1, "travel"))
    first = live.store.merchant_snapshot()
    assert live.store.merchant_snapshot() == first or live.store.merchant_snapshot().version == first.version
    live.seed(*((i, f"category {i}") for i in range(2, 200)))
    second = live.store.merchant_snapshot()
    assert second.version != first.version and second.size > 50 * first.size
    writer = merchant_stats_writer(live.store, 0, limit)
    assert live.run(txn(1, "00:00:10", 5.0), txn(2, "00:00:10", merchant=7), writer=writer) == [
        ("category 7", "Spain", 1.0, 1), ("travel", "Spain", 5.0, 1)]


def test_a_new_checkpoint_replaces_totals_like_the_other_sink(spark):
    live = Live(spark)
    live.seed((1, "travel"))
    live.run(txn(1, "00:00:10", 5.0), txn(2, "00:00:20", 1.0))
    live.run(txn(3, "00:00:30", 1.0))
    assert live.run(checkpoint="fresh") == [("travel", "Spain", 7.0, 3)]
    assert {run for run, _ in live.store.merchant_stats.batches()} == {0, 1}


def test_nulls_and_totals_kept_by_category(spark):
    live = Live(spark)
    live.seed((1, "travel"), (4, None))
    stream_of = [txn(1, "00:00:10", 5.0, country=None), txn(2, "00:00:20", merchant=4), txn(3, "00:00:20", merchant=None)]
    assert live.run(*stream_of) == [("travel", None, 5.0, 1)]
    # A store that also holds totals by category: those count only for groups the others lack.
    config = PipelineConfig(checkpoint_root=f"{live.work}/older")
    fixed = live.session.createDataFrame([(1, "travel"), (4, "zoo")], SEED)
    start_category_stats(file_stream(live.session, f"{live.work}/topic"), fixed, live.store, config, ONCE).awaitTermination()
    assert live.totals() == [("travel", None, 5.0, 1), ("zoo", "Spain", 1.0, 1)]
