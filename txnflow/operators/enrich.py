"""Merchant category lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.operators.sizes import DEFAULT_LIMIT_BYTES, is_small

DEFAULT_SALTS = 16
#: Merchants that a sketch names as hot, at most.
MOST_HOT = 64


def hot_merchants(transactions: DataFrame, most: int = MOST_HOT, share: float = 0.01) -> list[int]:
    """Merchants with about ``share`` or more of the rows, from a bounded sketch taken in one pass.

    The sketch keeps far more counters than it names; a merchant it misnames costs a few copies
    of one dimension row and no result.
    """
    top = F.expr(f"approx_top_k(merchant_id, {most}, {100 * most})")
    found = transactions.agg(top.alias("top"), F.count("merchant_id").alias("n")).first()
    return sorted(row["item"] for row in found["top"] or [] if row["item"] is not None and row["count"] >= share * found["n"])


def measured_strategy(merchants: DataFrame, streaming: bool, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> str:
    """The join strategy for a dimension of this measured size."""
    if is_small(merchants.select("merchant_id", "category"), limit_bytes):
        return "broadcast"
    return "salted" if streaming else "shuffle"


def enrich_merchant(
    transactions: DataFrame,
    merchants: DataFrame,
    *,
    strategy: str = "auto",
    limit_bytes: int = DEFAULT_LIMIT_BYTES,
    salts: int = DEFAULT_SALTS,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Left join on ``merchant_id``; unknown merchants keep a NULL category.

    ``broadcast``: no shuffle of the transactions; for a dimension of known small size.
    ``shuffle``: both sides are shuffled and adaptive execution splits a hot merchant.
    ``salted``: for stateful streams, which adaptive execution leaves alone. A ``hot`` merchant
    is repeated per salt and its transactions spread over ``salts`` tasks; the others join as
    they are. For a table the hot ones are found by a sketch unless given; of a stream that
    is given none, every merchant counts as hot. The dimension is never broadcast here, however
    small its files are: a stream's plan has only their size to go by, which repetition does not show in.
    ``auto`` measures the dimension once and takes ``broadcast`` within ``limit_bytes``,
    else ``salted`` for a stream and ``shuffle`` for a table.
    """
    dimension = merchants.select("merchant_id", "category")
    if strategy == "auto":
        strategy = measured_strategy(dimension, transactions.isStreaming, limit_bytes)
    if strategy == "broadcast":
        return transactions.join(F.broadcast(dimension), "merchant_id", "left")
    if strategy == "shuffle":
        return transactions.join(dimension, "merchant_id", "left")
    if strategy == "salted":
        if hot is None and not transactions.isStreaming:
            hot = hot_merchants(transactions)
        # Rows without a merchant join nothing wherever they are; many of them would be hot as well.
        is_hot = F.lit(True) if hot is None else F.col("merchant_id").isNull() | F.col("merchant_id").isin(list(hot))
        every = F.sequence(F.lit(0), F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0)))
        copies = dimension.withColumn("_salt", F.explode(every))
        spread = F.pmod(F.xxhash64("transaction_id", "transaction_date"), F.lit(salts)).cast("int")
        return (
            transactions.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
            .join(copies.hint("merge"), ["merchant_id", "_salt"], "left")
            .drop("_salt")
        )
    raise ValueError(f"unknown join strategy {strategy!r}")
