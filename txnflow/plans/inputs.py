"""The driver's tables as transactions, dimensions, envelopes, logs and graphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.functions.timetext import ISO_MICROS_OFFSET, as_utc
from txnflow.operators import graph as G
from txnflow.session import require_utc
from txnflow.sources.topics import as_envelope

TOPIC = "transactions"
TOPIC_PARTITIONS = 3
# Parts larger than this are no merchants, so their transactions stay without a category.
LARGEST_MERCHANT_SIZE = 40
# Merchants seeded at first where more are seeded while a stream runs, and whose category changes then.
SMALL_MERCHANT_SIZE = 20
RECLASSED_BRAND = "Brand#1"
ARRIVALS = 4


# Declared, so that opening a table reads no footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    require_utc(spark)
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation and region names. The two lookups hold a fixed number of rows.

    Left to choose, the plan may broadcast the customers to the nations: compressed, their file is small.
    """
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("r_name").alias("customer_country"),
            F.col("n_name").alias("customer_city"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def all_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("merchant_id"),
        F.col("p_name").alias("merchant_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        "p_size",
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchants a join finds; transactions of the others stay without a category."""
    return all_merchants(spark, sf_dir).where(F.col("p_size") <= LARGEST_MERCHANT_SIZE).drop("p_size")


def _nth(values: tuple[str, ...], key: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(F.col(key), F.lit(len(values))) + 1).cast("int"))


CURRENCIES = ("MXN", "USD", "CAD", "BRL", "EUR")
DEVICES = ("mobile", "desktop", "pos_terminal", "atm")
PAYMENTS = ("credit_card", "debit_card", "bank_transfer", "cash", "digital_wallet")


def timed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction in wire form, and the event's instant as ``event_ts``."""
    places = customers(spark, sf_dir).select("customer_id", "customer_country", "customer_city")
    event = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props", F.col("ts").cast("timestamp").alias("event_ts")
    )
    return event.join(places, F.col("user_id") == F.col("customer_id")).select(
        F.col("event_id").alias("transaction_id"),
        "customer_id",
        F.get_json_object("props", "$.k").cast("long").alias("merchant_id"),
        F.date_format("event_ts", ISO_MICROS_OFFSET).alias("transaction_date"),
        F.col("value").alias("amount"),
        _nth(CURRENCIES, "event_id").alias("currency"),
        F.col("customer_country").alias("transaction_country"),
        F.col("customer_city").alias("transaction_city"),
        _nth(PAYMENTS, "user_id").alias("payment_method"),
        F.when(F.col("event_type") == "purchase", "approved")
        .when(F.col("event_type") == "error", "declined")
        .otherwise("pending")
        .alias("status"),
        _nth(DEVICES, "event_id").alias("device_type"),
        F.concat(F.lit("event "), F.col("event_type")).alias("description"),
        "event_ts",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_transactions(spark, sf_dir).drop("event_ts")


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as the parser yields them, without the trip through JSON."""
    return timed_transactions(spark, sf_dir).withColumnRenamed("event_ts", "transaction_date_ts")


def envelope(
    spark: SparkSession, sf_dir: str, span: tuple[datetime, datetime] | None = None
) -> DataFrame:
    """Every transaction, or those of a time span, as messages of a topic with three partitions."""
    rows = timed_transactions(spark, sf_dir)
    wire = [c for c in rows.columns if c != "event_ts"]
    if span is not None:
        low, high = span
        rows = rows.where((F.col("event_ts") >= F.lit(low)) & (F.col("event_ts") < F.lit(high)))
    key, count = F.col("transaction_id"), F.lit(TOPIC_PARTITIONS)
    partition = F.pmod(key, count)
    messages = rows.select(
        key.cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*wire), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        partition.alias("_partition"),
        # The ids are dense, so the quotient numbers the messages of a partition without a window.
        ((key - partition) / count).cast("long").alias("_offset"),
        "event_ts",
    )
    return as_envelope(messages, TOPIC, F.col("_partition"), F.col("_offset"), F.col("event_ts"))


def stored_text(messages: DataFrame) -> DataFrame:
    """Messages whose text is fixed, as a stored topic's is.

    A filter on the text stays above the one-element ``inline``; moved below it, the filter
    would encode each row once more.
    """
    others = [c for c in messages.columns if c != "value"]
    return messages.select(*others, F.inline(F.array(F.struct("value")))).select(*messages.columns)


def arrivals(spark: SparkSession, sf_dir: str, count: int = ARRIVALS) -> list[tuple[datetime, datetime]]:
    """Equal spans of the events' time range, as half-open bounds in order."""
    low, high = (
        table(spark, sf_dir, "events")
        .agg(F.min("ts").cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz"))
        .first()
    )
    low, high = as_utc(low), as_utc(high)
    step = (high - low) / count
    edges = [low + i * step for i in range(count)] + [high + timedelta(microseconds=1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def land_in_order(spark: SparkSession, sf_dir: str, folder: str, late_text: str | None = None) -> Iterator[None]:
    """Write the messages span by span, yielding after each.

    A stream run after each step sees one span per micro-batch, so what is late does not
    depend on the order in which one job's files finish. Each step's time bound reaches the
    scan of the events, so all steps together read them once, or twice with ``late_text``:
    messages holding that text arrive one span late, those of the last span with it.
    """
    spans = arrivals(spark, sf_dir)
    for i, span in enumerate(spans):
        if late_text is None:
            landing = envelope(spark, sf_dir, span)
        else:
            late = F.contains(F.col("value").cast("string"), F.lit(late_text))
            here = stored_text(envelope(spark, sf_dir, span))
            landing = here if i == len(spans) - 1 else here.where(~late)
            if i > 0:
                landing = landing.unionByName(stored_text(envelope(spark, sf_dir, spans[i - 1])).where(late))
        landing.write.mode("append").parquet(folder)
        yield


def run_arrivals(steps: Iterator[None], start: Callable[[], object]) -> list:
    """Start the query after each landing and wait for it; returns the finished queries."""
    finished = []
    for _ in steps:
        query = start()
        query.awaitTermination()
        finished.append(query)
    return finished


# --- logs and graphs ---
def as_batch(rows: DataFrame, batch_id: int, run_seq: int = 0) -> DataFrame:
    return rows.withColumn("run_seq", F.lit(run_seq)).withColumn("batch_id", F.lit(batch_id).cast("long"))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction in the shape of the raw log."""
    return parsed(spark, sf_dir).select(
        "transaction_id", "customer_id", "merchant_id", "amount", "currency", "status",
        F.date_trunc("millisecond", "transaction_date_ts").alias("transaction_date"),
        F.lit(None).cast("string").alias("merchant_category"),
    )


def two_raw_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Approved rows first; then every row again with another amount, currency and customer."""
    rows = raw_rows(spark, sf_dir)
    again = rows.select(
        "transaction_id",
        (F.col("customer_id") + 1).alias("customer_id"),
        (F.col("merchant_id") + 1).alias("merchant_id"),
        (F.col("amount") + 1000).alias("amount"),
        F.lit("JPY").alias("currency"),
        "status", "transaction_date", "merchant_category",
    )
    return rows.where(F.col("status") == "approved"), again


def graph(spark: SparkSession, sf_dir: str, stats: DataFrame) -> G.Graph:
    """The graph after seeding every customer and merchant and storing every transaction."""
    raw_log = as_batch(raw_rows(spark, sf_dir), 0)
    listed = F.array(F.lit("customer_name"), F.lit("customer_country"), F.lit("customer_city"))
    customer_log = as_batch(
        customers(spark, sf_dir).select(
            "customer_id", "customer_name", F.lit(None).cast("string").alias("email"),
            "customer_country", "customer_city", F.lit(None).cast("int").alias("age"),
            F.lit(None).cast("date").alias("registration_date"), listed.alias("set_columns"),
        ), 0,
    )
    merchant_log = as_batch(
        all_merchants(spark, sf_dir).select(
            "merchant_id", "merchant_name", "category",
            F.lit(None).cast("string").alias("merchant_country"),
            F.lit(None).cast("string").alias("merchant_city"),
            F.array(F.lit("merchant_name"), F.lit("category")).alias("set_columns"),
        ), 0,
    )
    return G.Graph.from_logs(raw_log, customer_log, merchant_log, as_batch(stats, 0))
