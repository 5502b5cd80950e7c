"""Key constraints as data-quality jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.operators.graph import STATS_KEY, TRANSACTION_KEY, Graph

UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "Customer": ("customer_id",),
    "Merchant": ("merchant_id",),
    "Transaction": TRANSACTION_KEY,
    "CategoryStats": STATS_KEY,
}


def shown_key(keys: Sequence[str]) -> Column:
    """A key as text; one of several parts is a JSON list, in which a NULL differs from any text."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))


def duplicate_keys(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = UNIQUE_KEYS
) -> DataFrame:
    """Keys that occur more than once, as text; empty when every constraint holds."""
    checks = []
    for label, rows in tables.items():
        checks.append(
            rows.groupBy(*keys[label])
            .agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1)
            .select(F.lit(label).alias("label"), shown_key(keys[label]).alias("key"), "cnt")
        )
    return reduce(DataFrame.unionByName, checks)


def transactions_with_two_makers(graph: Graph) -> DataFrame:
    """Transactions that more than one customer made, as reused ids of a second run cause."""
    return duplicate_keys({"MADE": graph.made}, {"MADE": ("transaction_id",)})
