"""foreachBatch writers of the two sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from txnflow.functions.timetext import stored_time
from txnflow.operators import graph as G
from txnflow.operators.enrich import enrich_merchant
from txnflow.operators.filters import has_keys
from txnflow.operators.sizes import DEFAULT_LIMIT_BYTES
from txnflow.operators.stats import stats_payload
from txnflow.operators.upsert import dedup
from txnflow.streaming.store import GraphStore

logger = logging.getLogger("txnflow.consumer")

BatchWriter = Callable[[DataFrame, int], None]


def log_batch(sink: str, batch_id: int, rows: int) -> None:
    """The commit line that ``sources.textlogs.batch_commits`` reads."""
    if rows:
        logger.info("[%s] batch=%d rows=%d", sink, batch_id, rows)
    else:
        logger.info("[%s] batch=%d empty", sink, batch_id)


def raw_log_rows(rows: DataFrame) -> DataFrame:
    """Parsed rows in the shape of the raw log, still with their full-precision event time."""
    return rows.select(
        "transaction_id", "customer_id", "merchant_id", "amount", "currency", "status",
        "transaction_date_ts", stored_time("transaction_date_ts").alias("transaction_date"),
        F.lit(None).cast("string").alias("merchant_category"),
    )


def dedup_batch(log_rows: DataFrame) -> DataFrame:
    """One row per transaction of a batch: the earliest event, ties broken by content."""
    return dedup(log_rows, ["transaction_id"], ["transaction_date_ts"]).drop("transaction_date_ts")


def raw_graph_writer(store: GraphStore, run_seq: int) -> BatchWriter:
    """Sink of single transactions.

    A batch is one write of one wide table, so its nodes and edges appear together. Counts
    are observed while writing; a second pass over the batch happens only when it holds
    rejects, which are approved rows lacking a key or an event time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen, written = Observation(f"seen-{batch_id}"), Observation(f"written-{batch_id}")
        checked = batch.observe(seen, F.count_if(~has_keys()).alias("rejected"))
        rows = dedup_batch(raw_log_rows(checked.where(has_keys())))
        store.raw.write(rows.observe(written, F.count(F.lit(1)).alias("rows")), run_seq, batch_id)
        if seen.get["rejected"]:
            store.rejects.write(batch.where(~has_keys()).drop("transaction_date_ts"), run_seq, batch_id)
            logger.warning("[raw_graph] batch=%d rejected=%d", batch_id, seen.get["rejected"])
        log_batch("raw_graph", batch_id, written.get["rows"])

    return write


_CUSTOMER, _TRANSACTION, _MERCHANT = (
    ("Customer", "customer_id"), ("Transaction", "transaction_id"), ("Merchant", "merchant_id"),
)
SERVER_STATS_KEY = ("category", "transaction_country", "window_start_iso")


def raw_server_writer(server) -> BatchWriter:
    """Sink of single transactions on a graph server, such as ``graphdb.ConnectorServer``.

    The server creates what it lacks and changes nothing else, so no batch reads the graph and
    a replayed batch changes nothing. Nodes go before the edges that need them, and edges with
    an end in common in one task, where they do not wait for each other's locks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dedup_batch(raw_log_rows(batch.where(has_keys()))).persist()
        try:
            log = rows.withColumns({"run_seq": F.lit(0), "batch_id": F.lit(batch_id).cast("long")})
            for (label, key), nodes, created in (
                (_CUSTOMER, G.customer_stubs(log), ()), (_MERCHANT, G.merchant_stubs(log), ("category",)),
                (_TRANSACTION, G.transaction_nodes(log), ("amount", "currency", "status", "transaction_date")),
            ):
                server.merge_nodes(nodes, label, (key,), created=created)
            for edge, source, target, shared, edges, created in (
                ("MADE", _CUSTOMER, _TRANSACTION, "customer_id", G.made_edges(log), ("amount", "currency", "timestamp")),
                ("AT", _TRANSACTION, _MERCHANT, "merchant_id", G.at_edges(log), ()),
            ):
                server.merge_edges(edges.repartition(shared), edge, source, target, created=created)
            log_batch("raw_graph", batch_id, rows.count())
        finally:
            rows.unpersist()

    return write


def stats_server_writer(server) -> BatchWriter:
    """Sink of window totals on a graph server; a later row of a window overwrites the earlier one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        written = Observation(f"sent-{batch_id}")
        rows = stats_payload(batch).withColumn("updated_at", F.current_timestamp())
        values = tuple(c for c in rows.columns if c not in SERVER_STATS_KEY)
        server.merge_nodes(
            rows.observe(written, F.count(F.lit(1)).alias("rows")), "CategoryStats", SERVER_STATS_KEY, overwritten=values
        )
        log_batch("category_stats", batch_id, written.get["rows"])

    return write


def category_stats_writer(store: GraphStore, run_seq: int) -> BatchWriter:
    """Sink of window totals; a later batch's row for a window replaces the earlier one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        written = Observation(f"written-{batch_id}")
        rows = (
            # A few rows from each of the state's partitions: written as few files.
            batch.withColumn("updated_at", F.current_timestamp()).hint("rebalance")
            .sortWithinPartitions("window_start")
            .observe(written, F.count(F.lit(1)).alias("rows"))
        )
        store.stats.write(rows, run_seq, batch_id)
        log_batch("category_stats", batch_id, written.get["rows"])

    return write


def merchant_stats_writer(store: GraphStore, run_seq: int, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> BatchWriter:
    """Sink of totals per merchant, each with the merchant's category as of this batch.

    The state knows merchants only, so what is seeded while the stream runs counts from the
    next batch on. A batch holds a merchant once per window and country, so none is hot in the join;
    the dimension is broadcast if this version of it was measured to be small. A replayed
    batch takes the version it took before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        written = Observation(f"written-{batch_id}")
        snapshot = store.snapshot_for(run_seq, batch_id)
        strategy = "broadcast" if snapshot.size <= limit_bytes else "shuffle"
        rows = (
            enrich_merchant(batch, snapshot.rows, strategy=strategy)
            .withColumn("updated_at", F.current_timestamp()).hint("rebalance")
            .sortWithinPartitions("window_start")
            .observe(written, F.count("category").alias("rows"))
        )
        store.merchant_stats.write(rows, run_seq, batch_id)
        log_batch("category_stats", batch_id, written.get["rows"])

    return write
