from collections import Counter
from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from txnflow import schemas as S
from txnflow.functions.messages import encode_messages, parse_transactions
from txnflow.functions.picks import MODULUS, draw
from txnflow.session import work_folder
from txnflow.sources.records import (
    build_customers,
    build_merchants,
    build_transactions,
    id_range,
    spaced_times,
    transaction_stream,
)


def test_customers(spark):
    found = build_customers(id_range(spark, 1000)).collect()
    assert len(found) == 1000
    assert {c["customer_country"] for c in found} == set(S.COUNTRIES)
    assert {c["customer_city"] for c in found} == set(S.CITIES)
    assert min(c["age"] for c in found) == 18 and max(c["age"] for c in found) == 80
    days = [date.fromisoformat(c["registration_date"]) for c in found]
    assert min(days) >= date(2018, 1, 1) and max(days) <= date(2018, 1, 1).replace(year=2023, month=12, day=31)
    seven = next(c for c in found if c["customer_id"] == 7)
    assert (seven["customer_name"], seven["email"]) == ("Customer_7", "customer_7@example.com")


def test_rows_do_not_depend_on_partitioning(spark):
    ids = id_range(spark, 500)
    for build in (build_customers, build_merchants):
        assert rows(build(ids.repartition(7))) == rows(build(ids.coalesce(1)))
        assert rows(build(ids, seed=5)) != rows(build(ids, seed=6))


def test_merchants(spark):
    found = build_merchants(id_range(spark, 200)).collect()
    assert {m["category"] for m in found} == set(S.CATEGORIES)
    assert found[0]["merchant_name"] == "Merchant_1"


def test_transactions(spark):
    frame = build_transactions(id_range(spark, 5000), spaced_times("2024-05-01 00:00:00"), customers=10, merchants=4)
    found = frame.collect()
    assert frame.columns == list(S.TRANSACTION_COLUMNS)
    assert {t["customer_id"] for t in found} == set(range(1, 11)) and {t["merchant_id"] for t in found} == {1, 2, 3, 4}
    assert {t["status"] for t in found} == set(S.STATUSES)
    assert {t["payment_method"] for t in found} == set(S.PAYMENT_METHODS)
    assert {t["device_type"] for t in found} == set(S.DEVICE_TYPES)
    assert {t["currency"] for t in found} == set(S.CURRENCIES)
    assert all(10 <= t["amount"] <= 50_000 and round(t["amount"], 2) == t["amount"] for t in found)
    first = next(t for t in found if t["transaction_id"] == 1)
    assert first["transaction_date"] == "2024-05-01T00:00:00+00:00"
    assert first["description"] == "synthetic_transaction_description_1_streaming_big_data_project"
    second = next(t for t in found if t["transaction_id"] == 2)
    assert second["transaction_date"] == "2024-05-01T00:00:00.200000+00:00"
    counts = Counter((t["status"], t["currency"]) for t in found)
    assert len(counts) == 15 and min(counts.values()) > 250


def test_draws_cover_large_ids(spark):
    ids = spark.sql("select id from values (1L), (2147483648L), (9223372036854775807L), (0L) as t(id)")
    found = [r[0] for r in ids.select(draw("id", 1, 2)).collect()]
    assert len(set(found)) == 4 and all(0 <= f < MODULUS for f in found)


def test_generated_messages_parse_back(spark):
    made = build_transactions(id_range(spark, 50), spaced_times("2024-05-01 00:00:00"))
    back = parse_transactions(encode_messages(made).withColumn("timestamp", F.current_timestamp()))
    assert rows(back, *S.TRANSACTION_COLUMNS) == rows(made)
    assert back.where("transaction_date_ts is null").count() == 0


def test_endless_stream(spark):
    stream = transaction_stream(spark, rows_per_second=50, partitions=2)
    assert stream.isStreaming and stream.columns == list(S.TRANSACTION_COLUMNS)
    work = work_folder(spark, "rate")
    query = (
        stream.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/cp").start()
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if any(p.numInputRows for p in query.recentProgress[:-1]):
                break
    finally:
        query.stop()
    ids = [r[0] for r in rows(spark.read.parquet(f"{work}/out"), "transaction_id")]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and ids
    assert isinstance(spark.read.parquet(f"{work}/out").select(F.try_to_timestamp("transaction_date")).first()[0], datetime)
