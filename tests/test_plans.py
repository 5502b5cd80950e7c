"""Shape of the physical plans."""

import re

import pytest
from helpers import envelope, merchants, txn
from pyspark.sql import functions as F

from txnflow.operators import graph as G
from txnflow.operators.filters import parse_approved
from txnflow.operators.stats import category_stats, category_stats_of, stats_payload
from txnflow.operators.enrich import enrich_merchant
from txnflow.plans.queries import registered
from txnflow.schemas import RAW_LOG
from txnflow.session import work_folder
from txnflow.sources.topics import file_batch

SMALL = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def topic(spark):
    folder = work_folder(spark, "topic")
    envelope(spark, [txn(i, "10:00:00", merchant=i % 2) for i in range(10)]).write.parquet(folder)
    return folder


@pytest.fixture(scope="module")
def dimension_file(spark):
    folder = work_folder(spark, "merchants")
    merchants(spark).write.parquet(folder)
    return folder


def test_window_path(spark, topic, dimension_file):
    stats = category_stats(
        enrich_merchant(parse_approved(file_batch(spark, topic)), spark.read.parquet(dimension_file), strategy="broadcast"))
    plan = plan_of(stats)
    assert plan.count("from_json") == 1
    assert re.search(r"BroadcastHashJoin .*Inner, BuildRight", plan)
    assert "IsNotNull(category)" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_sum" in plan
    assert re.search(r"ReadSchema: struct<value:binary>", plan)


def test_large_dimension_path_has_no_broadcast(spark, topic, dimension_file):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(category_stats_of(
            parse_approved(file_batch(spark, topic)), spark.read.parquet(dimension_file), limit_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert plan.index("SortMergeJoin") < plan.rindex("partial_sum")


def test_views_read_only_the_columns_a_query_uses(spark):
    folder = work_folder(spark, "raw")
    spark.createDataFrame([], f"{RAW_LOG}, run_seq INT, batch_id BIGINT").write.parquet(folder)
    log = spark.read.parquet(folder)
    status = plan_of(G.transaction_nodes(log).where(F.col("status") == "approved").select("transaction_id"))
    assert re.search(r"ReadSchema: struct<transaction_id:bigint,status:string,run_seq:int,batch_id:bigint>", status)
    count = plan_of(G.made_edges(log).agg(F.count(F.lit(1))))
    assert re.search(r"ReadSchema: struct<transaction_id:bigint,customer_id:bigint>", count)


def test_top_k_keeps_no_full_sort(spark):
    for name in ("top_customer_approved", "transaction_paths", "latest_messages", "top_categories_last_hour"):
        plan = plan_of(registered()[name](spark, SMALL))
        assert "TakeOrderedAndProject" in plan, name


def test_latest_messages_parse_after_the_limit(spark):
    plan = plan_of(registered()["latest_messages"](spark, SMALL))
    assert plan.index("from_json") < plan.index("TakeOrdered")


BATCH_ONLY = sorted(
    name for name in registered()
    if not re.search("stream|pipeline|compacted|late|log|commits|produced|upsert|edge|two_maker", name)
)


@pytest.mark.parametrize("name", BATCH_ONLY)
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(registered()[name](spark, SMALL))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_stats_payload_counts_fit_the_sink(spark):
    stats = spark.sql("select 'a' category, 'b' country, timestamp'2024-05-01' window_start, "
                      "timestamp'2024-05-02' window_end, 1.0D total_amount, 3L txn_count")
    assert dict(stats_payload(stats).dtypes)["txn_count"] == "int"
    assert dict(stats_payload(stats, "long").dtypes)["txn_count"] == "bigint"


def test_paths_shuffle_edges_by_their_keys_only(spark, monkeypatch):
    """The first edges are taken by key, and what lies along them is cut to these keys in the scans."""
    folder = work_folder(spark, "raw")
    log = [(i, i % 7, i % 5, float(i), "EUR", "approved", None, None, 0, 0) for i in range(100)]
    spark.createDataFrame(log, f"{RAW_LOG}, run_seq INT, batch_id BIGINT").write.parquet(folder)
    raw = spark.read.parquet(folder)
    seeds = spark.createDataFrame([], "customer_id BIGINT, merchant_id BIGINT, set_columns ARRAY<STRING>, run_seq INT, batch_id BIGINT")
    for c in (*G.CUSTOMER_COLUMNS, *G.MERCHANT_COLUMNS):
        seeds = seeds.withColumn(c, F.lit(None).cast("string"))
    graph = G.Graph.from_logs(raw, seeds, seeds, raw)
    edges = graph.made.select("customer_id", "transaction_id").orderBy("customer_id", "transaction_id").limit(25)
    plan = plan_of(edges)
    assert plan.count("Exchange hashpartitioning") == 1 and "TakeOrderedAndProject" in plan
    assert re.search(r"ReadSchema: struct<transaction_id:bigint,customer_id:bigint>", plan)
    paths = G.transaction_paths(graph, 10)
    want = sorted((r[1], r[0], r[2]) for r in log)[:10]
    assert [tuple(r) for r in paths.collect()] == want
    details = plan_of(G.path_details(graph, paths))
    assert details.count("In(transaction_id") == 2 and "EqualTo(customer_id,0)" in details and "In(merchant_id" in details


def test_only_hot_merchants_are_copied(spark):
    from txnflow.operators.enrich import hot_merchants

    rows = spark.createDataFrame(
        [(i, "t", 1 if i % 2 else 1000 + i) for i in range(2000)] + [(-1, "t", None)],
        "transaction_id BIGINT, transaction_date STRING, merchant_id BIGINT")
    assert hot_merchants(rows) == [1]
    assert hot_merchants(rows.limit(0)) == []
    dimension = spark.createDataFrame([(m, f"c{m}") for m in (1, *range(1000, 3000))], "merchant_id BIGINT, category STRING")
    joined = enrich_merchant(rows, dimension, strategy="salted")
    found = {r["transaction_id"]: r["category"] for r in joined.collect()}
    assert len(found) == joined.count() == 2001
    assert found[3] == "c1" and found[4] == "c1004" and found[-1] is None
