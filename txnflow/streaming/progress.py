"""Progress of streaming queries as rows."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txnflow.session import path_exists, write_text

PROGRESS = "batch BIGINT, input_rows BIGINT, watermark STRING, dropped_rows BIGINT, state_rows BIGINT"
COMMITTED = "partition INT, end_offset BIGINT"
# What is read of a report; offsets differ by source and stay text.
_REPORT = """
    id STRING, runId STRING, name STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT,
    eventTime STRUCT<watermark: STRING>,
    stateOperators ARRAY<STRUCT<numRowsDroppedByWatermark: BIGINT, numRowsTotal: BIGINT>>,
    sources ARRAY<STRUCT<description: STRING, endOffset: STRING>>
"""


class EndedRuns(StreamingQueryListener):
    """A listener that tells when all reports of a run have reached it.

    Reports arrive some time after their batch, and the end of a run after all of its reports.
    """

    def __init__(self) -> None:
        self._lock, self._ends = threading.Lock(), {}

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ends.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 120) -> None:
        """Return once every report of an ended query has been taken in."""
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError(f"the end of run {query.runId} was not reported within {timeout} s")


class ProgressLog(EndedRuns):
    """Every progress report of a session's queries, a file each in a folder all can read.

    A file is named by query, run and batch, so a report that comes twice is there once. What
    Spark itself keeps is bounded and gone with the driver; this table is neither.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self.spark, self.folder = spark, folder

    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryProgress(self, event) -> None:
        report = event.progress
        name = f"{report.id}-{report.runId}-{report.batchId}.json"
        write_text(self.spark, f"{self.folder}/{name}", json.dumps(json.loads(report.json)))


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The logged reports: query, run and batch, the columns of ``PROGRESS``, and the sources."""
    if path_exists(spark, folder):
        lines = spark.read.text(folder)
    else:
        lines = spark.createDataFrame([], "value STRING")
    report = lines.select(F.inline(F.array(F.from_json("value", _REPORT))))

    def total(field: str):
        return F.coalesce(F.aggregate(
            "stateOperators", F.lit(0).cast("long"), lambda acc, op: acc + F.coalesce(op[field], F.lit(0))
        ), F.lit(0).cast("long"))

    return report.select(
        F.col("id").alias("query_id"), F.col("runId").alias("run_id"), "name", F.col("batchId").alias("batch"),
        F.col("numInputRows").alias("input_rows"), F.col("eventTime.watermark").alias("watermark"),
        total("numRowsDroppedByWatermark").alias("dropped_rows"), total("numRowsTotal").alias("state_rows"),
        F.try_to_timestamp("timestamp").alias("reported_at"), "sources",
    )


def logged_offsets(progress: DataFrame, topic: str) -> DataFrame:
    """End offset per partition of a topic, from the newest report of each partition on."""
    offsets = F.from_json("source.endOffset", "MAP<STRING, MAP<STRING, BIGINT>>")[topic]
    read = progress.select(F.explode("sources").alias("source")).select(F.explode(offsets).alias("partition", "end"))
    return read.groupBy(F.col("partition").cast("int").alias("partition")).agg(F.max("end").alias("end_offset"))


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """The progress reports the query still holds; Spark bounds their number, ``ProgressLog`` has all."""
    rows = []
    for report in query.recentProgress:
        report = json.loads(report.json)
        state = report.get("stateOperators") or []
        rows.append((
            report["batchId"],
            report["numInputRows"],
            (report.get("eventTime") or {}).get("watermark"),
            sum(op["numRowsDroppedByWatermark"] for op in state),
            sum(op["numRowsTotal"] for op in state),
        ))
    return rows


def progress_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), PROGRESS)


def committed_offsets(spark: SparkSession, query: StreamingQuery, topic: str) -> DataFrame:
    """End offset per partition of the last finished batch of a topic subscription."""
    last = query.lastProgress
    found = []
    for source in json.loads(last.json)["sources"] if last else []:
        end = source.get("endOffset")
        end = json.loads(end) if isinstance(end, str) else end
        if isinstance(end, dict):
            found += [(int(p), int(o)) for p, o in end.get(topic, {}).items()]
    return spark.createDataFrame(found, COMMITTED)
