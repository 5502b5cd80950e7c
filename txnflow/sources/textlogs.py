"""Text logs of producer and consumer runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.schemas import BATCH_COMMIT_PATTERN, PRODUCED_PATTERN


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.text(folder)


def batch_commits(lines: DataFrame) -> DataFrame:
    """``(sink, batch, rows, logged_at)`` of each commit line; other lines, also of empty batches, drop out.

    ``logged_at`` is the time the line begins with, NULL where it begins with none.
    """
    line = F.col("value")
    time = F.try_to_timestamp(F.substring(line, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    return lines.where(F.rlike(line, F.lit(BATCH_COMMIT_PATTERN))).select(
        F.regexp_extract(line, BATCH_COMMIT_PATTERN, 1).alias("sink"),
        F.regexp_extract(line, BATCH_COMMIT_PATTERN, 2).cast("long").alias("batch"),
        F.regexp_extract(line, BATCH_COMMIT_PATTERN, 3).cast("long").alias("rows"),
        time.alias("logged_at"),
    )


def produced_count(lines: DataFrame) -> DataFrame:
    """The highest count the producer reported, 0 when it reported none."""
    found = F.regexp_extract_all("value", F.lit(PRODUCED_PATTERN), F.lit(1))
    highest = F.array_max(F.transform(found, lambda n: n.cast("long")))
    return lines.select(F.coalesce(F.max(highest), F.lit(0).cast("long")).alias("produced"))
