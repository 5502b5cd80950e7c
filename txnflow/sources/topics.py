"""Message topics: Kafka and file envelopes behind one row shape."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnflow.schemas import ENVELOPE

# Fixed delivery settings of the producing side.
PRODUCER_SETTINGS = {
    "acks": "all",
    "retries": "5",
    "linger.ms": "20",
    "max.in.flight.requests.per.connection": "5",
    "request.timeout.ms": "30000",
    "reconnect.backoff.ms": "500",
    "reconnect.backoff.max.ms": "10000",
}


def kafka_source_options(
    bootstrap: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic subscription.

    Without a checkpoint the stream starts at ``starting_offsets``; offsets lost to
    retention are skipped. ``max_offsets_per_trigger`` bounds a micro-batch, and
    ``min_partitions`` splits few or uneven topic partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **(extra or {})}


def kafka_sink_options(bootstrap: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    options.update({f"kafka.{name}": value for name, value in PRODUCER_SETTINGS.items()})
    return {**options, **(extra or {})}


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_source_options(bootstrap, topic, **options)).load()


def kafka_batch(
    spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """A bounded read of the topic; it joins no consumer group."""
    options = kafka_source_options(bootstrap, topic, starting_offsets=starting)
    return spark.read.format("kafka").options(**options, endingOffsets=ending).load()


def write_kafka(messages: DataFrame, bootstrap: str, topic: str) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    options: Mapping[str, str],
    *,
    sink: str = "kafka",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Publish a stream of ``(key, value)`` messages as they arise.

    ``options`` are those of ``kafka_sink_options``, or of another ``sink``. After a restart
    the last batch may be published again, as a retried send may be.
    """
    return (
        messages.select("key", "value")
        .writeStream.queryName("publisher").format(sink).options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def file_stream(
    spark: SparkSession,
    folder: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """The envelope read as a stream from a folder of Parquet files."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(folder)


def file_batch(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(folder)


def store_topic(messages: DataFrame, folder: str) -> None:
    """Append messages to a topic of files, laid out by partition and in offset order.

    Files hold narrow ranges of offsets, so bounds come from their footers and a tail opens few.
    """
    (messages.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
        .write.mode("append").partitionBy("partition").parquet(folder))


def stored_end_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """End offset per partition of such a topic, from the files' footers alone."""
    # Footers answer an aggregate only through the second version of the file readers.
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    topic = footers.read.schema(ENVELOPE).parquet(folder)
    return topic.groupBy("partition").agg(F.max("offset").alias("_last")).select(
        "partition", (F.col("_last") + 1).alias("end_offset")
    )


def tail_starts(ends: DataFrame, n: int) -> dict[int, int]:
    """Per partition the offset of its ``n``-th newest message; a topic has few partitions."""
    return {row["partition"]: max(row["end_offset"] - n, 0) for row in ends.collect()}


def stored_tail(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The ``n`` newest messages of each partition; files without any of them are skipped."""
    starts = tail_starts(stored_end_offsets(spark, folder), n)
    newest = F.lit(False)
    for partition, start in starts.items():
        newest = newest | ((F.col("partition") == partition) & (F.col("offset") >= start))
    # Stated once more without the partition: this form reaches the files' statistics.
    return file_batch(spark, folder).where(newest).where(F.col("offset") >= min(starts.values(), default=0))


def kafka_tail(spark: SparkSession, bootstrap: str, topic: str, ends: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest messages of each partition, and any that came after ``ends`` was taken.

    ``ends`` are end offsets, such as ``progress.logged_offsets``; no earlier message is fetched.
    """
    starts = {str(partition): start for partition, start in tail_starts(ends, n).items()}
    return kafka_batch(spark, bootstrap, topic, starting=json.dumps({topic: starts}))


def as_envelope(
    messages: DataFrame, topic: str, partition: Column, offset: Column, timestamp: Column
) -> DataFrame:
    """``(key, value, ...)`` rows in the shape a topic subscription delivers."""
    return messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
