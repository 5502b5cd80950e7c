"""Hand-made transactions and envelopes."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from txnflow.schemas import ENVELOPE

DAY = "2024-05-01T"


def txn(transaction_id, at, amount=1.0, *, merchant=1, customer=1, status="approved", country="Spain", **more):
    """A transaction as the producer sends it; ``at`` is a time of one day."""
    return {
        "transaction_id": transaction_id, "customer_id": customer, "merchant_id": merchant,
        "transaction_date": f"{DAY}{at}+00:00", "amount": amount, "currency": "EUR",
        "transaction_country": country, "transaction_city": "Madrid", "payment_method": "cash",
        "status": status, "device_type": "atm", "description": "d", **more,
    }


def envelope_row(value, offset=0, partition=0, key=None):
    body = value if isinstance(value, (str, type(None))) else json.dumps(value)
    return (
        None if key is None else key.encode(), None if body is None else body.encode(),
        "transactions", partition, offset, datetime(2024, 5, 1, tzinfo=timezone.utc), 0,
    )


def envelope(spark, values):
    return spark.createDataFrame([envelope_row(v, i) for i, v in enumerate(values)], ENVELOPE)


def land(spark, folder, values):
    """One more file of messages."""
    envelope(spark, values).coalesce(1).write.mode("append").parquet(folder)


def merchants(spark, rows=((1, "travel"), (2, "health"))):
    return spark.createDataFrame(list(rows), "merchant_id BIGINT, category STRING")


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
