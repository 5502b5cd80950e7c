import json
from datetime import date

import pytest
from helpers import envelope, envelope_row, rows, txn
from pyspark.sql import functions as F

from txnflow.functions.messages import encode_messages, json_object, may_have_status, parse_transactions
from txnflow.functions.timetext import event_date, event_time, iso_micros, iso_millis, stored_time
from txnflow.operators.filters import (
    filter_approved,
    parse_approved,
    project_transaction,
    since,
    split_rejects,
)
from txnflow.schemas import ENVELOPE, TRANSACTION, TRANSACTION_COLUMNS

SMALL = "id INT, amount DOUBLE, status STRING"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"id": 1, "amount": 2.5, "status": "approved"}', (1, 2.5, "approved")),
        ('{"id": 1, "amount": "abc", "status": "approved"}', (1, None, "approved")),
        ('{"id": 99999999999, "amount": 1, "status": "a"}', (None, 1.0, "a")),
        ('{"id": 1.5, "amount": 1, "status": "a"}', (None, 1.0, "a")),
        ('{"id": "5", "amount": "6.5", "status": "a"}', (None, None, "a")),
        ('{"ID": 1, "amount": 1, "status": "a"}', (None, 1.0, "a")),
        ('{"id": 1, "extra": [1], "amount": 1, "status": "a"}', (1, 1.0, "a")),
        ("not json", (None, None, None)),
        ("[1, 2]", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_json_cases(spark, text, expected):
    frame = spark.createDataFrame([envelope_row(text)], ENVELOPE)
    parsed = frame.select(json_object(F.col("value"), SMALL).alias("t")).select("t.*")
    assert tuple(parsed.first()) == expected


def test_nan_amount_parses(spark):
    frame = envelope(spark, ['{"id": 1, "amount": NaN, "status": "a"}'])
    amount = frame.select(json_object(F.col("value"), SMALL).alias("t")).first()["t"]["amount"]
    assert amount != amount


@pytest.mark.parametrize(
    ("text", "iso"),
    [
        ("2024-05-01T10:00:00.123456+00:00", "2024-05-01T10:00:00.123Z"),
        ("2024-05-01T10:00:00-05:00", "2024-05-01T15:00:00.000Z"),
        ("2024-05-01T10:00:00Z", "2024-05-01T10:00:00.000Z"),
        ("2024-05-01T10:00:00", "2024-05-01T10:00:00.000Z"),
        ("2024-05-01 10:00:00.5", "2024-05-01T10:00:00.500Z"),
        ("2024-05-01", "2024-05-01T00:00:00.000Z"),
        ("junk", None),
        ("2024-13-01T00:00:00", None),
        (None, None),
    ],
)
def test_event_time_texts(spark, text, iso):
    frame = spark.createDataFrame([(text,)], "text STRING")
    assert frame.select(iso_millis(event_time("text"))).first()[0] == iso


def test_time_texts(spark):
    frame = spark.sql(
        "select timestamp'2024-05-01 10:00:00.123456' as a, timestamp'2024-05-01 10:00:00' as b, '2020-02-29' as d"
    )
    row = frame.select(
        iso_micros(F.col("a")), iso_micros(F.col("b")), iso_millis(stored_time("a")), event_date("d")
    ).first()
    assert tuple(row) == (
        "2024-05-01T10:00:00.123456+00:00", "2024-05-01T10:00:00+00:00", "2024-05-01T10:00:00.123Z",
        date(2020, 2, 29),
    )


def test_parse_fields_and_message_time(spark):
    parsed = parse_transactions(envelope(spark, [txn(7, "10:00:00.5")]))
    assert parsed.columns == [*TRANSACTION_COLUMNS, "kafka_ts", "transaction_date_ts"]
    row = parsed.select("transaction_id", "kafka_ts", iso_millis("transaction_date_ts")).first()
    assert row[0] == 7 and row[1] is not None and row[2] == "2024-05-01T10:00:00.500Z"


def test_malformed_gives_null_row_which_the_filter_drops(spark):
    parsed = parse_transactions(envelope(spark, ["oops", None, txn(1, "10:00:00")]))
    assert parsed.count() == 3
    assert rows(filter_approved(parsed), "transaction_id") == [(1,)]


def test_narrow_ids_drop_large_ones_and_wide_ids_keep_them(spark):
    raw = envelope(spark, [txn(99_999_999_999, "10:00:00")])
    assert parse_transactions(raw, TRANSACTION).first()["transaction_id"] is None
    assert parse_transactions(raw).first()["transaction_id"] == 99_999_999_999


def test_prefilter_keeps_every_approved_message(spark):
    escaped = json.dumps(txn(3, "10:00:00")).replace("approved", "\\u0061pproved")
    values = [
        txn(1, "10:00:00"), txn(2, "10:00:00", status="declined"), escaped,
        txn(4, "10:00:00", status="Approved"), txn(5, "10:00:00", status=None),
        txn(6, "10:00:00", status="pending", description="approved later"), "junk approved", None,
    ]
    raw = envelope(spark, values)
    plain = filter_approved(parse_transactions(raw))
    assert rows(parse_approved(raw)) == rows(plain)
    assert rows(plain, "transaction_id") == [(1,), (3,)]
    assert may_have_status(raw, "approved").count() == 4


def test_rejects(spark):
    values = [
        txn(1, "10:00:00"), txn(None, "10:00:00"), txn(2, "nonsense"), txn(3, "10:00:00", customer=None),
        txn(4, "10:00:00", merchant="x"), txn(5, "10:00:00", amount="abc"),
    ]
    good, bad = split_rejects(parse_approved(envelope(spark, values)))
    assert rows(good, "transaction_id") == [(1,), (5,)]
    assert rows(bad, "transaction_id") == [(2,), (3,), (4,), (None,)]


def test_projection_for_the_sink(spark):
    row = project_transaction(parse_approved(envelope(spark, [txn(1, "10:00:00.123456")]))).first()
    assert row["transaction_date_iso"] == "2024-05-01T10:00:00.123Z"
    assert row["merchant_category"] is None
    assert len(row) == 8


def test_encode_messages(spark):
    frame = spark.createDataFrame([(1, "Málaga", None), (None, "x", 2.5)], "id BIGINT, city STRING, amount DOUBLE")
    found = {r["key"]: json.loads(bytes(r["value"])) for r in encode_messages(frame, "id").collect()}
    key = next(k for k in found if k is not None)
    assert bytes(key) == b"1"
    assert found[key] == {"id": 1, "city": "Málaga", "amount": None}
    assert found[None] == {"id": None, "city": "x", "amount": 2.5}


def test_since_with_given_and_current_time(spark):
    frame = spark.sql("select current_timestamp() - interval 30 minutes as t union all select current_timestamp() - interval 2 hours")
    assert frame.where(since("t", F.current_timestamp(), "1 HOUR")).count() == 1
