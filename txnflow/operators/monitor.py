"""Topic and consumer progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.functions.messages import json_object
from txnflow.schemas import WIDE_TRANSACTION


def end_offsets(envelope: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """End offset per partition, at least the one ``known`` for it.

    Retention removes messages but moves no end offset back, so a partition without messages
    keeps what is known of it.
    """
    ends = envelope.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
    if known is None:
        return ends
    both = ends.unionByName(known.select("partition", "end_offset"))
    return both.groupBy("partition").agg(F.max("end_offset").alias("end_offset"))


def topic_high_water(envelope: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Sum over partitions of the end offset, 0 for an empty topic."""
    return high_water(end_offsets(envelope, known))


def high_water(ends: DataFrame) -> DataFrame:
    """``topic_high_water`` from end offsets per partition."""
    return ends.agg(F.coalesce(F.sum("end_offset"), F.lit(0)).alias("hwm"))


def consumer_lag(envelope: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages per partition after the committed end offset.

    A partition never read lags in full; one read to its end whose messages are gone lags 0.
    """
    return lag_behind(end_offsets(envelope, committed), committed)


def lag_behind(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """``consumer_lag`` from end offsets per partition, such as ``topics.stored_end_offsets``."""
    done = committed.select("partition", F.col("end_offset").alias("_done"))
    return ends.join(done, "partition", "left").select(
        "partition",
        F.greatest(F.col("end_offset") - F.coalesce(F.col("_done"), F.lit(0)), F.lit(0)).alias("lag"),
    )


def latest_messages(envelope: DataFrame, n: int = 15, schema: str = WIDE_TRANSACTION) -> DataFrame:
    """The ``n`` newest messages; only those are parsed.

    The generator stays above the limit, where a projection would be moved below it and
    parse every message.
    """
    newest = envelope.orderBy(F.desc("timestamp"), F.desc("partition"), F.desc("offset")).limit(n)
    body = json_object(F.col("value"), schema)
    return newest.select("timestamp", "partition", "offset", F.inline(F.array(body)))


def latest_commits(commits: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` newest commits by the time of their line; batch numbers of two sinks do not compare."""
    return commits.orderBy(F.desc_nulls_last("logged_at"), "sink", F.desc("batch")).limit(n)
