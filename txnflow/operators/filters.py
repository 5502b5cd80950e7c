"""Row filters and projections over parsed transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions.messages import may_have_status, parse_transactions
from txnflow.functions.timetext import iso_millis
from txnflow.schemas import WIDE_TRANSACTION

APPROVED = "approved"


def filter_approved(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == F.lit(APPROVED))


def parse_approved(raw: DataFrame, schema: str = WIDE_TRANSACTION) -> DataFrame:
    """``filter_approved(parse_transactions(raw))`` without parsing most other messages."""
    return filter_approved(parse_transactions(may_have_status(raw, APPROVED), schema))


def has_keys() -> Column:
    """True where a parsed row can become nodes and edges."""
    return (
        F.col("transaction_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("merchant_id").isNotNull()
        & F.col("transaction_date_ts").isNotNull()
    )


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the graph, and the rest."""
    return parsed.where(has_keys()), parsed.where(~has_keys())


def project_transaction(rows: DataFrame) -> DataFrame:
    """The columns the raw sink sends to a graph server, with a category that is always NULL."""
    return rows.select(
        "transaction_id",
        "customer_id",
        "merchant_id",
        "amount",
        "currency",
        "status",
        iso_millis("transaction_date_ts").alias("transaction_date_iso"),
        F.lit(None).cast("string").alias("merchant_category"),
    )


def since(column: str, as_of: Column, lookback: str) -> Column:
    """True from ``lookback`` (interval text) before ``as_of`` on."""
    return F.col(column) >= as_of - F.expr(f"INTERVAL {lookback}")
