"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
Each query runs once untimed on the same tables, so class loading and code generation are
not part of its time, and then BENCH_REPEATS times (default 3), of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnflow.plans.queries import registered  # noqa: E402
from txnflow.session import session_options  # noqa: E402

HEADLINE = (
    "parse_transactions", "filter_approved", "encode_messages", "dedup_transactions", "enrich_merchant",
    "category_stats", "category_stats_large_dim", "upsert_transaction", "edge_made", "upsert_customers",
    "top_categories_last_hour", "top_customer_approved", "transaction_paths", "label_counts",
    "topic_high_water", "latest_messages", "batch_commit_log", "gen_transactions",
    "stream_ingest", "stream_category_stats", "category_stats_pipeline", "raw_graph_pipeline",
)
# Queries over every event, for a throughput figure next to the time.
PER_EVENT = (
    "parse_transactions", "category_stats", "stream_category_stats", "category_stats_pipeline", "raw_graph_pipeline",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("txnflow-bench")
    options = {
        **session_options(cpus, "default"), "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "events_per_sec": {name: round(events / times[name]) for name in PER_EVENT},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
