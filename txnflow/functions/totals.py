"""Order-independent money totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this, neighbouring doubles are too far apart to tell cents from noise.
_LARGEST_CENTS_AMOUNT = 9.0e13


def money_parts(amount: str, prefix: str) -> tuple[Column, Column]:
    """Two aggregates whose combination is ``sum(amount)``.

    Amounts with at most two decimals are added as whole cents, so the total does not depend
    on the order tasks finish in; the decimal sum has room for more rows than can occur. Any
    other amount is added as a double. NULLs are skipped by both.
    """
    value = F.col(amount)
    cents = F.when(F.abs(value) < F.lit(_LARGEST_CENTS_AMOUNT), F.rint(value * 100)).cast("long")
    is_cents = F.coalesce(cents / F.lit(100.0) == value, F.lit(False))
    return (
        F.sum(F.when(is_cents, cents.cast("decimal(17,0)"))).alias(f"{prefix}_cents"),
        F.sum(F.when(~is_cents, value)).alias(f"{prefix}_rest"),
    )


def money_total(prefix: str) -> Column:
    cents, rest = F.col(f"{prefix}_cents"), F.col(f"{prefix}_rest")
    whole = cents.cast("double") / F.lit(100.0)
    return F.when(rest.isNull(), whole).when(cents.isNull(), rest).otherwise(whole + rest)
