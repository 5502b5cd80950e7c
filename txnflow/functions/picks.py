"""Seeded picks that depend on the row's id only, never on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus and multipliers of the public Lehmer generators (Park and Miller; Fishman and Moore).
MODULUS = 2_147_483_647
FIRST_MULTIPLIER = 48_271
HIGH_MULTIPLIER = 16_807
SECOND_MULTIPLIER = 69_621
SALT_STEP = 104_729


def draw(id_column: Column | str, seed: int, salt: int) -> Column:
    """A number in ``[0, MODULUS)`` for the id, different for each ``salt``.

    Integer arithmetic that stays inside 64 bits, so it runs in generated code and can be
    written the same way in any SQL dialect.
    """
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    key = key.cast("long")
    low = F.pmod(key, F.lit(MODULUS))
    # An exact multiple below 2**63: the double quotient is within 2**-20 of its integer.
    high = F.pmod(F.rint((key - low) / F.lit(float(MODULUS))).cast("long"), F.lit(MODULUS))
    x = (low * FIRST_MULTIPLIER + high * HIGH_MULTIPLIER + (seed + salt * SALT_STEP)) % MODULUS
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * SECOND_MULTIPLIER + salt) % MODULUS
    return x.bitwiseXOR(F.shiftright(x, 13)) % MODULUS


def pick(pool: Sequence[str], drawn: Column) -> Column:
    choices = F.array(*(F.lit(v) for v in pool))
    return F.element_at(choices, (drawn % len(pool) + 1).cast("int"))


def between(low: int, high: int, drawn: Column) -> Column:
    """A uniform integer in the closed range."""
    return drawn % (high - low + 1) + low
