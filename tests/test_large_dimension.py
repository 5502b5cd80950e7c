"""The statistics streams over a dimension beyond the broadcast limit."""

import pytest
from check import compare, connect
from helpers import merchants
from pyspark.sql import functions as F

from txnflow.operators.enrich import enrich_merchant
from txnflow.plans import inputs, oracles, queries

SF = "/root/testdata/sf0.001"
STREAMS = (
    "category_stats_pipeline",
    "late_data_trace",
    "stream_category_stats",
    "stream_progress",
    "category_stats_compacted",
    "open_windows",
)


@pytest.mark.parametrize("name", STREAMS)
def test_stream_joins_it_without_a_broadcast(spark, monkeypatch, name):
    """Its copies never meet on the driver, and the rows are those of the SQL all the same."""
    plans = []

    def run(steps, start, arrivals=inputs.run_arrivals):
        finished = arrivals(steps, start)
        plans.extend(query._jsq.explainInternal(False) for query in finished)
        return finished

    monkeypatch.setattr(queries, "measured_strategy", lambda merchants, streaming: "salted")
    monkeypatch.setattr(inputs, "run_arrivals", run)
    count, difference = compare(spark, connect(SF), queries.registered()[name], oracles.oracle_sql()[name], SF)
    assert difference is None and count > 0
    assert len(plans) == inputs.ARRIVALS
    for plan in plans:
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("hot", [(), (1,)])
def test_rows_without_a_merchant_are_spread(spark, hot):
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", "8")
    rows = own.range(200).selectExpr("id transaction_id", "'t' transaction_date", "CAST(NULL AS BIGINT) merchant_id")
    joined = enrich_merchant(rows, merchants(own), strategy="salted", hot=hot)
    placed = joined.select("category", F.spark_partition_id().alias("part"))
    assert placed.where("category IS NULL").count() == 200
    assert placed.select("part").distinct().count() > 1
