"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_LIMIT_BYTES = 64 * 1024 * 1024
# Row header, hash table slot and one word per fixed-width column.
_ROW_BYTES = 48
_FIELD_BYTES = 8


def measured_bytes(df: DataFrame) -> int:
    """In-memory size estimate from one aggregate over the rows; only one row reaches the driver."""
    per_row = F.lit(_ROW_BYTES + _FIELD_BYTES * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            per_row = per_row + F.octet_length(F.to_json(F.struct(field.name)))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def is_small(df: DataFrame, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit_bytes


def broadcast_if_small(df: DataFrame, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its measured size allows it, else unchanged."""
    return F.broadcast(df) if is_small(df, limit_bytes) else df
