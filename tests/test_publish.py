"""Continuous publishing, to files in place of a broker."""

import time

from txnflow.functions.messages import encode_messages, parse_transactions
from txnflow.session import work_folder
from txnflow.sources.records import transaction_stream
from txnflow.sources.topics import publish_stream


def test_generated_transactions_are_published_as_they_arise(spark):
    work = work_folder(spark, "publish")
    messages = encode_messages(transaction_stream(spark, rows_per_second=50))
    query = publish_stream(messages, f"{work}/cp", {"path": f"{work}/out"}, sink="parquet")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (query.lastProgress and query.lastProgress.numInputRows):
            time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    published = spark.read.parquet(f"{work}/out")
    ids = [int(bytes(r["key"])) for r in published.collect()]
    assert ids and len(set(ids)) == len(ids)
    parsed = parse_transactions(published.selectExpr("*", "timestamp'2024-05-01 00:00:00' as timestamp"))
    assert parsed.where("transaction_id is not null and amount > 0").count() == len(ids)
