"""Windowed category totals and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.functions.timetext import iso_millis
from txnflow.functions.totals import money_parts, money_total
from txnflow.operators.enrich import enrich_merchant
from txnflow.operators.filters import since
from txnflow.operators.sizes import DEFAULT_LIMIT_BYTES, is_small
from txnflow.operators.upsert import BATCH, RUN


def category_stats(enriched: DataFrame, window: str = "1 minute") -> DataFrame:
    """Total and count per (tumbling window, category, country), for tables and streams.

    Rows without an event time fall out with the window; rows without a category are
    removed after the aggregate; a NULL country is a group of its own.
    """
    totals = (
        enriched.groupBy(
            F.window("transaction_date_ts", window), F.col("category"), F.col("transaction_country")
        )
        .agg(*money_parts("amount", "_amount"), F.count(F.lit(1)).alias("txn_count"))
        .where(F.col("category").isNotNull())
    )
    return _flat(totals)


def _flat(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("category"),
        F.col("transaction_country").alias("country"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        money_total("_amount").alias("total_amount"),
        F.col("txn_count"),
    )


def category_stats_of(
    transactions: DataFrame,
    merchants: DataFrame,
    window: str = "1 minute",
    limit_bytes: int = DEFAULT_LIMIT_BYTES,
) -> DataFrame:
    """``category_stats`` over a table of transactions and a merchant dimension of any size.

    A small dimension is broadcast and the rows shuffle once, already partly totalled. For a
    large one the totals are first taken per merchant, so the join shuffles one row per
    (window, merchant, country) and no merchant is hot in it.
    """
    dimension = merchants.select("merchant_id", "category")
    if is_small(dimension, limit_bytes):
        return category_stats(enrich_merchant(transactions, dimension, strategy="broadcast"), window)
    per_merchant = transactions.groupBy(
        F.window("transaction_date_ts", window), "merchant_id", "transaction_country"
    ).agg(*money_parts("amount", "_part"), F.count(F.lit(1)).alias("_part_count"))
    totals = (
        enrich_merchant(per_merchant, dimension, strategy="shuffle")
        .where(F.col("category").isNotNull())
        .groupBy("window", "category", "transaction_country")
        .agg(
            F.sum("_part_cents").alias("_amount_cents"),
            F.sum("_part_rest").alias("_amount_rest"),
            F.sum("_part_count").alias("txn_count"),
        )
    )
    return _flat(totals)


def merchant_totals(transactions: DataFrame, window: str = "1 minute") -> DataFrame:
    """Totals per (tumbling window, merchant, country), for tables and streams; no category is needed."""
    totals = transactions.groupBy(
        F.window("transaction_date_ts", window), "merchant_id", "transaction_country"
    ).agg(*money_parts("amount", "amount"), F.count(F.lit(1)).alias("txn_count"))
    return totals.select(
        "merchant_id", F.col("transaction_country").alias("country"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.col("amount_cents").cast("decimal(27,0)").alias("amount_cents"), "amount_rest", "txn_count",
    )


_MERCHANT_KEY = (RUN, "merchant_id", "country", "window_start", "window_end")


def category_spans(log: DataFrame) -> DataFrame:
    """Of a log of running totals, the last row before each change of a merchant's category.

    These rows say all that ``category_stats_by_merchant`` needs, so a log may be folded to them.
    """
    following = F.lead(F.struct("category")).over(Window.partitionBy(*_MERCHANT_KEY).orderBy(BATCH))
    ends = F.col("_next").isNull() | ~F.col("_next.category").eqNullSafe(F.col("category"))
    return log.withColumn("_next", following).where(ends).drop("_next")


def category_stats_by_merchant(log: DataFrame) -> DataFrame:
    """``category_stats`` from running totals per merchant.

    What a merchant took in while it had a category counts for that category, and nothing while
    it had none. A merchant whose category never changes adds its total as it stands. A later
    run's total of a group replaces an earlier one's, as a log of category totals has it.
    """
    by_batch = Window.partitionBy(*_MERCHANT_KEY).orderBy(BATCH)
    added = {
        c: F.col(c) - F.coalesce(F.lag(c).over(by_batch), F.lit(0).cast(kind))
        for c, kind in (("amount_cents", "decimal(27,0)"), ("amount_rest", "double"), ("txn_count", "long"))
    }
    totals = (
        category_spans(log).withColumns(added).where(F.col("category").isNotNull())
        .groupBy(RUN, "category", "country", "window_start", "window_end")
        .agg(*(F.sum(c).alias(c) for c in added), F.max("updated_at").alias("updated_at"))
    )
    columns = ("window_end", *added, "updated_at")
    newest = totals.groupBy("category", "country", "window_start").agg(
        F.max_by(F.struct(*columns), RUN).alias("_row")
    )
    return newest.select("category", "country", "window_start", "_row.*").select(
        "category", "country", "window_start", "window_end", money_total("amount").alias("total_amount"),
        "txn_count", "updated_at",
    )


def stats_payload(stats: DataFrame, count_type: str = "int") -> DataFrame:
    """Statistics rows as a graph server receives them: window bounds as ISO text."""
    return stats.select(
        "category",
        F.col("country").alias("transaction_country"),
        iso_millis("window_start").alias("window_start_iso"),
        iso_millis("window_end").alias("window_end_iso"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("txn_count").cast(count_type).alias("txn_count"),
    )


def top_categories(
    stats: DataFrame, as_of: Column | None = None, lookback: str = "1 hour", n: int = 10
) -> DataFrame:
    """The ``n`` largest (category, country) totals over windows that began in the look-back.

    Ties are broken by category and country. With a literal ``as_of`` the range test reaches
    the scan of the statistics table.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    return (
        stats.where(since("window_start", as_of, lookback))
        .groupBy("category", "country")
        .agg(*money_parts("total_amount", "_amount"), F.sum("txn_count").alias("txn_count"))
        .select("category", "country", money_total("_amount").alias("total_amount"), "txn_count")
        .orderBy(F.desc("total_amount"), "category", "country")
        .limit(n)
    )
