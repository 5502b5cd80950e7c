import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_graph import SHOPS, raw

from txnflow.session import work_folder
from txnflow.streaming.audit import CONSTRAINTS, KeyAudit
from txnflow.streaming.store import GraphStore

ALL = ("check_number", "label", "rule", "key", "cnt")


@pytest.fixture
def store(spark):
    store = GraphStore(spark, work_folder(spark, "audit"))
    store.raw.write(raw(spark, [(i, 1, 1, 1.0, "approved") for i in range(1, 6)]), 0, 0)
    return store


def test_sound_store_has_no_violations(store):
    audit = KeyAudit(store)
    assert rows(audit.violations()) == []
    assert audit.check(upto=(0, 0)) == 0
    assert rows(audit.violations()) == []


def test_only_new_batches_are_told(spark, store):
    audit = KeyAudit(store)
    store.raw.write(raw(spark, [(2, 7, 1, 1.0, "approved"), (8, 1, 1, 1.0, "approved"), (8, 1, 1, 2.0, "approved")]), 0, 1)
    assert audit.check(upto=(0, 0)) == 0
    assert audit.check(upto=(0, 1)) == 2
    found = [(1, "MADE", "maker", "2", 2), (1, "Transaction", "batch", "8", 2)]
    assert rows(audit.violations(), *ALL) == found
    assert audit.check(upto=(0, 1)) == 0
    store.raw.write(raw(spark, [(9, 1, 1, 1.0, "approved")]), 0, 2)
    assert audit.check(upto=(0, 2)) == 0
    assert rows(audit.violations(), *ALL) == found


def test_newest_batch_waits_without_upto(spark, store):
    audit = KeyAudit(store)
    store.raw.write(raw(spark, [(1, 2, 1, 1.0, "approved")]), 0, 1)
    assert audit.check() == 0
    store.raw.write(raw(spark, [(20, 1, 1, 1.0, "approved")]), 0, 2)
    assert audit.check() == 1


def test_second_maker_against_a_base(spark, store):
    audit = KeyAudit(store)
    audit.check(upto=(0, 0))
    store.compact_raw(upto=(0, 0))
    store.expire("raw_graph")
    store.raw.write(raw(spark, [(3, 9, 1, 1.0, "approved")]), 0, 1)
    assert audit.check(upto=(0, 1)) == 1
    assert rows(audit.violations(), *ALL) == [(1, "MADE", "maker", "3", 2)]


def test_batches_deleted_before_a_check(spark, store):
    store.raw.write(raw(spark, [(3, 9, 1, 1.0, "approved")]), 0, 1)
    store.compact_raw(upto=(0, 1))
    store.expire("raw_graph")
    assert store.raw.batches() == []
    audit = KeyAudit(store)
    assert audit.check() == 1
    assert rows(audit.violations(), "label", "key") == [("MADE", "3")]


def test_key_twice_in_a_base(spark, store):
    store.compact_raw(upto=(0, 0))
    part = store.base("raw_graph", "Transaction").parts[0]
    copy = spark.read.parquet(part).where("transaction_id in (1, 5)")
    spark.createDataFrame(copy.collect(), copy.schema).write.mode("append").parquet(part)
    store.raw.write(raw(spark, [(5, 1, 1, 1.0, "approved"), (9, 1, 1, 1.0, "approved")]), 0, 1)
    audit = KeyAudit(store)
    # The first check looks at every key it finds in the log, a later one at what is new.
    assert audit.check(upto=(0, 1)) == 2
    assert rows(audit.violations(), "rule", "key", "cnt") == [("base", "1", 2), ("base", "5", 2)]
    store.raw.write(raw(spark, [(4, 1, 1, 1.0, "approved"), (1, 1, 1, 1.0, "approved")]), 0, 2)
    assert audit.check(upto=(0, 2)) == 1
    assert rows(audit.violations().where("check_number = 1"), "rule", "key") == [("base", "1")]


def test_statistics_and_seeds(spark, store):
    stats = spark.createDataFrame([("travel", None)] * 2 + [("health", "Spain")], "category STRING, country STRING")
    stats = stats.withColumn("window_start", F.expr("timestamp'2024-05-01 10:00:00'"))
    fields = store.stats.read().drop("run_seq", "batch_id").schema
    filled = (F.col(f.name) if f.name in stats.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields)
    store.stats.write(stats.select(*filled), 0, 0)
    store.seed_merchants(spark.createDataFrame([(1, "a", "travel", "Spain", "Madrid")] * 2, SHOPS))
    seeds = store.merchant_seed.read().drop("run_seq", "batch_id")
    store.merchant_seed.write(seeds.unionByName(seeds), 0, store.merchant_seed.claim())
    audit = KeyAudit(store)
    assert audit.check(upto=(0, 0)) == 2
    assert rows(audit.violations(), "label", "rule", "key", "cnt") == [
        ("CategoryStats", "batch", '["travel",null,"2024-05-01 10:00:00"]', 2), ("Merchant", "batch", "1", 2)]


def test_base_scan_is_bounded_by_the_touched_keys(spark, store):
    store.compact_raw(upto=(0, 0))
    audit = KeyAudit(store)
    audit.check(upto=(0, 0))
    store.raw.write(raw(spark, [(3, 1, 1, 1.0, "approved"), (4, 1, 1, 1.0, "approved")]), 0, 1)
    plans = [
        frame._jdf.queryExecution().executedPlan().toString()
        for frame in audit._broken(CONSTRAINTS[0], store.raw, {0: 0}, {0: 1})
    ]
    assert any("GreaterThanOrEqual(transaction_id,3)" in plan and "LessThanOrEqual(transaction_id,4)" in plan
               for plan in plans)
