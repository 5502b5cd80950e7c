"""Synthetic customers, merchants and transactions as column expressions over an id column.

Each value depends on its id and the seed only, so any number of tasks builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow import schemas as S
from txnflow.functions.picks import between, draw, pick
from txnflow.functions.timetext import iso_micros


def id_range(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1..n."""
    return spark.range(1, n + 1)


def build_customers(ids: DataFrame, seed: int = S.CUSTOMER_SEED_NUMBER) -> DataFrame:
    """One customer per ``id``; ``registration_date`` is ISO date text."""
    days = between(0, S.REGISTRATION_SPAN_DAYS, draw("id", seed, 1)).cast("int")
    text_id = F.col("id").cast("string")
    return ids.select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit(S.CUSTOMER_NAME_PREFIX), text_id).alias("customer_name"),
        F.concat(F.lit(S.CUSTOMER_EMAIL_PREFIX), text_id, F.lit(S.CUSTOMER_EMAIL_SUFFIX)).alias("email"),
        pick(S.COUNTRIES, draw("id", seed, 2)).alias("customer_country"),
        pick(S.CITIES, draw("id", seed, 3)).alias("customer_city"),
        between(*S.AGE_RANGE, draw("id", seed, 4)).cast("int").alias("age"),
        F.date_format(F.date_add(F.lit(S.FIRST_REGISTRATION).cast("date"), days), "yyyy-MM-dd")
        .alias("registration_date"),
    )


def build_merchants(ids: DataFrame, seed: int = S.MERCHANT_SEED_NUMBER) -> DataFrame:
    return ids.select(
        F.col("id").alias("merchant_id"),
        F.concat(F.lit(S.MERCHANT_NAME_PREFIX), F.col("id").cast("string")).alias("merchant_name"),
        pick(S.CATEGORIES, draw("id", seed, 1)).alias("category"),
        pick(S.COUNTRIES, draw("id", seed, 2)).alias("merchant_country"),
        pick(S.CITIES, draw("id", seed, 3)).alias("merchant_city"),
    )


def build_transactions(
    ids: DataFrame,
    at: Column,
    *,
    customers: int = S.DEFAULT_CUSTOMERS,
    merchants: int = S.DEFAULT_MERCHANTS,
    seed: int = 0,
) -> DataFrame:
    """One transaction per ``id``, dated ``at``; amounts are uniform over whole cents."""
    return ids.select(
        F.col("id").alias("transaction_id"),
        between(1, customers, draw("id", seed, 1)).alias("customer_id"),
        between(1, merchants, draw("id", seed, 2)).alias("merchant_id"),
        iso_micros(at).alias("transaction_date"),
        (between(*S.AMOUNT_CENTS_RANGE, draw("id", seed, 3)) / F.lit(100.0)).alias("amount"),
        pick(S.CURRENCIES, draw("id", seed, 4)).alias("currency"),
        pick(S.COUNTRIES, draw("id", seed, 5)).alias("transaction_country"),
        pick(S.CITIES, draw("id", seed, 6)).alias("transaction_city"),
        pick(S.PAYMENT_METHODS, draw("id", seed, 7)).alias("payment_method"),
        pick(S.STATUSES, draw("id", seed, 8)).alias("status"),
        pick(S.DEVICE_TYPES, draw("id", seed, 9)).alias("device_type"),
        F.concat(F.lit(S.DESCRIPTION_PREFIX), F.col("id").cast("string"), F.lit(S.DESCRIPTION_SUFFIX))
        .alias("description"),
    )


def spaced_times(start: str, interval_ms: int = 200) -> Column:
    """Event times for ids 1, 2, ...: ``start`` and then one every ``interval_ms``."""
    micros = F.unix_micros(F.lit(start).cast("timestamp")) + (F.col("id") - 1) * (interval_ms * 1000)
    return F.timestamp_micros(micros)


def transaction_stream(
    spark: SparkSession,
    *,
    rows_per_second: int = 5,
    partitions: int = 1,
    customers: int = S.DEFAULT_CUSTOMERS,
    merchants: int = S.DEFAULT_MERCHANTS,
    seed: int = 0,
) -> DataFrame:
    """An endless stream of transactions, dated when they arise, with ids from 1."""
    ticks = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )
    ids = ticks.select((F.col("value") + 1).alias("id"), F.col("timestamp"))
    return build_transactions(ids, F.col("timestamp"), customers=customers, merchants=merchants, seed=seed)
