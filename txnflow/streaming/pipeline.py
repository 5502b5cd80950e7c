"""The two streaming queries and their settings."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnflow.operators.enrich import enrich_merchant
from txnflow.operators.filters import parse_approved
from txnflow.operators.stats import category_stats, merchant_totals
from txnflow.schemas import WIDE_TRANSACTION
from txnflow.sources.topics import kafka_stream
from txnflow.streaming.sinks import (
    BatchWriter, category_stats_writer, merchant_stats_writer, raw_graph_writer, raw_server_writer, stats_server_writer,
)
from txnflow.streaming.store import GraphStore


@dataclass(frozen=True)
class PipelineConfig:
    bootstrap: str | None = None
    topic: str = "transactions"
    app_name: str = "streaming-transactions"
    checkpoint_root: str = "./checkpoints"
    watermark: str = "1 minute"
    window: str = "1 minute"
    schema: str = WIDE_TRANSACTION
    stats_mode: str = "update"
    dedup_window_path: bool = False
    join_strategy: str = "auto"
    #: Merchants whose transactions a salted join spreads, such as ``enrich.hot_merchants`` of the raw log names.
    hot_merchants: tuple[int, ...] | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    store_root: str = "./graph"
    #: Where the sinks write: ``files`` of the store, or a graph ``server``.
    sink: str = "files"
    shuffle_partitions: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> PipelineConfig:
        env = os.environ if env is None else env
        return cls(
            bootstrap=env["KAFKA_BOOTSTRAP_SERVERS"],
            topic=env["KAFKA_TOPIC"],
            app_name=env.get("SPARK_APP_NAME", cls.app_name),
            checkpoint_root=env.get("SPARK_CHECKPOINT_DIR", cls.checkpoint_root),
            watermark=env.get("SPARK_WATERMARK", cls.watermark),
            window=env.get("SPARK_WINDOW_DURATION", cls.window),
            store_root=env.get("GRAPH_STORE_ROOT", cls.store_root),
            sink=env.get("GRAPH_SINK", cls.sink),
            **{
                name: int(env[variable])
                for name, variable in (
                    ("max_offsets_per_trigger", "MAX_OFFSETS_PER_TRIGGER"),
                    ("min_partitions", "MIN_PARTITIONS"),
                    ("shuffle_partitions", "SPARK_SHUFFLE_PARTITIONS"),
                )
                if env.get(variable)
            },
        )

    def checkpoint(self, sink: str) -> str:
        return f"{self.checkpoint_root}/{sink}"


def approved_stream(raw: DataFrame, config: PipelineConfig) -> DataFrame:
    """Approved transactions with an event-time watermark.

    The watermark follows the status filter: declined and pending rows never advance it.
    """
    return parse_approved(raw, config.schema).withWatermark("transaction_date_ts", config.watermark)


def windowed_stats(approved: DataFrame, merchants: DataFrame, config: PipelineConfig) -> DataFrame:
    """Window totals of the approved stream.

    Repeated ids count twice unless ``dedup_window_path`` is set, as replays of the topic do.
    """
    if config.dedup_window_path:
        approved = approved.dropDuplicatesWithinWatermark(["transaction_id"])
    enriched = enrich_merchant(approved, merchants, strategy=config.join_strategy, hot=config.hot_merchants)
    return category_stats(enriched, config.window)


def frozen(dimension: DataFrame) -> DataFrame:
    """Keep a dimension as read at the start; otherwise each micro-batch scans its files again."""
    return dimension.persist()


def start_raw_graph(
    raw: DataFrame, store: GraphStore, config: PipelineConfig, trigger: Mapping | None = None,
    writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Single transactions into the store, or wherever ``writer`` puts them."""
    checkpoint = config.checkpoint("raw_graph")
    runs = store.runs("raw_graph")
    run_seq, recorded = runs.run_for(checkpoint)
    query = (
        approved_stream(raw, config)
        .writeStream.queryName("raw_graph_sink")
        .foreachBatch(writer or raw_graph_writer(store, run_seq))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
    if not recorded:
        runs.record(query.id, run_seq)
    return query


def start_category_stats(
    raw: DataFrame, merchants: DataFrame, store: GraphStore, config: PipelineConfig,
    trigger: Mapping | None = None, writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Window totals into the store, or wherever ``writer`` puts them."""
    checkpoint = config.checkpoint("category_stats")
    runs = store.runs("category_stats")
    run_seq, recorded = runs.run_for(checkpoint)
    query = (
        windowed_stats(approved_stream(raw, config), merchants, config)
        .writeStream.queryName("category_stats_sink")
        .foreachBatch(writer or category_stats_writer(store, run_seq))
        .option("checkpointLocation", checkpoint)
        .outputMode(config.stats_mode)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
    if not recorded:
        runs.record(query.id, run_seq)
    return query


def start_merchant_stats(
    raw: DataFrame, store: GraphStore, config: PipelineConfig, trigger: Mapping | None = None,
    writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Window totals whose merchants are looked up in the store batch by batch, as they are then."""
    checkpoint = config.checkpoint("merchant_stats")
    runs = store.runs("merchant_stats")
    run_seq, recorded = runs.run_for(checkpoint)
    approved = approved_stream(raw, config)
    if config.dedup_window_path:
        approved = approved.dropDuplicatesWithinWatermark(["transaction_id"])
    query = (
        merchant_totals(approved, config.window)
        .writeStream.queryName("category_stats_sink")
        .foreachBatch(writer or merchant_stats_writer(store, run_seq))
        .option("checkpointLocation", checkpoint)
        .outputMode(config.stats_mode)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
    if not recorded:
        runs.record(query.id, run_seq)
    return query


def start_pipeline(
    raw: DataFrame, store: GraphStore, config: PipelineConfig, merchants: DataFrame | None = None,
    trigger: Mapping | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both sinks off one source; each reads it with offsets and a checkpoint of its own.

    Without ``merchants`` the categories follow what is seeded into the store.
    """
    raw_graph = start_raw_graph(raw, store, config, trigger)
    if merchants is None:
        return raw_graph, start_merchant_stats(raw, store, config, trigger)
    return raw_graph, start_category_stats(raw, merchants, store, config, trigger)


def start_server_pipeline(
    raw: DataFrame, store: GraphStore, server, config: PipelineConfig, trigger: Mapping | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both sinks on a graph server, whose merchants are the dimension; the store numbers the runs."""
    merchants = server.merchants(raw.sparkSession)
    return (
        start_raw_graph(raw, store, config, trigger, writer=raw_server_writer(server)),
        start_category_stats(raw, merchants, store, config, trigger, writer=stats_server_writer(server)),
    )


def run_kafka_pipeline(spark: SparkSession, store: GraphStore, config: PipelineConfig, server=None) -> None:
    """Run on a Kafka topic until one of the queries ends; ``server`` takes the place of the store's files."""
    options = {
        "max_offsets_per_trigger": config.max_offsets_per_trigger, "min_partitions": config.min_partitions,
    }
    raw = kafka_stream(spark, config.bootstrap, config.topic, **options)
    if server is not None:
        start_server_pipeline(raw, store, server, config)
    else:
        start_pipeline(raw, store, config)
    spark.streams.awaitAnyTermination()


def start_ingest(raw: DataFrame, folder: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Append the envelope, as delivered, to Parquet files."""
    return (
        raw.withColumn("ingest_date", F.to_date("timestamp"))
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
