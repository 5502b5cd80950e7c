"""Message envelope to typed transaction rows, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.schemas import WIDE_TRANSACTION


def may_have_status(raw: DataFrame, status: str) -> DataFrame:
    """Drop messages that cannot carry ``status``, before any JSON parsing.

    A JSON text whose string value decodes to ``status`` holds it literally, or spells part
    of it with a backslash escape. Keeping both kinds keeps every wanted message; the exact
    test still follows the parse.
    """
    text = F.col("value").cast("string")
    return raw.where(F.contains(text, F.lit(status)) | F.contains(text, F.lit("\\")))


def parse_transactions(raw: DataFrame, schema: str = WIDE_TRANSACTION) -> DataFrame:
    """Envelope rows to transaction fields, ``kafka_ts`` and ``transaction_date_ts``.

    A malformed message gives a row of NULLs, a field of the wrong type is NULL on its own,
    and a date that is no timestamp gives a NULL ``transaction_date_ts``. The one-element
    ``inline`` keeps later filters above the parse: under a plain projection the optimizer
    copies ``from_json`` into each pushed predicate and parses the text again for each.
    """
    text = F.from_json(F.col("value").cast("string"), schema)
    return (
        raw.select(F.inline(F.array(text)), F.col("timestamp").alias("kafka_ts"))
        .withColumn("transaction_date_ts", F.try_to_timestamp("transaction_date"))
    )


def json_object(value: Column, schema: str = WIDE_TRANSACTION) -> Column:
    """Message bytes to a struct, for readers that need the payload only."""
    return F.from_json(value.cast("string"), schema)


def encode_messages(rows: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows to ``(key, value)``: key as text bytes (NULL stays NULL), row as JSON bytes."""
    body = F.to_json(F.struct(*(F.col(c) for c in rows.columns)), {"ignoreNullFields": "false"})
    return rows.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )
