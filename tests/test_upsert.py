import pytest
from helpers import rows

from txnflow.operators.upsert import (
    BatchLog,
    RunRegistry,
    dedup,
    first_write,
    keys_of,
    last_write,
    last_write_partial,
    merge_base,
)
from txnflow.session import work_folder

LOG = "id BIGINT, value STRING, run_seq INT, batch_id BIGINT"


def log(spark):
    return spark.createDataFrame(
        [(1, "a", 0, 0), (1, "b", 0, 1), (2, None, 0, 0), (2, "c", 0, 10), (2, "d", 0, 9), (None, "n", 0, 2),
         (1, "z", 1, 0)],
        LOG,
    )


def test_first_write_keeps_the_earliest_also_when_null(spark):
    assert rows(first_write(log(spark), ["id"])) == [(1, "a"), (2, None), (None, "n")]


def test_last_write_orders_runs_before_batches(spark):
    assert rows(last_write(log(spark), ["id"])) == [(1, "z"), (2, "c"), (None, "n")]


def test_keys(spark):
    assert rows(keys_of(log(spark), ["id"])) == [(1,), (2,), (None,)]


def test_partial_overwrite_touches_listed_columns_only(spark):
    frame = spark.createDataFrame(
        [(1, "n1", "e1", ["name", "mail"], 0, 0), (1, None, None, ["mail"], 0, 1), (1, "n2", "x", ["name"], 0, 2),
         (2, "only", None, ["name"], 0, 0)],
        "id INT, name STRING, mail STRING, set_columns ARRAY<STRING>, run_seq INT, batch_id BIGINT",
    )
    assert rows(last_write_partial(frame, ["id"], ["name", "mail"])) == [(1, "n2", None), (2, "only", None)]


def test_dedup_is_deterministic(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 9, "0"), (2, None, "x"), (2, 1, "y")]
    for parts in (1, 3):
        frame = spark.createDataFrame(data, "id INT, at INT, value STRING").repartition(parts)
        assert rows(dedup(frame, ["id"], ["at"])) == [(1, 5, "a"), (2, None, "x")]


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        ("first", [("a", None, 1), ("b", "X", 2), ("c", "X", 30)]),
        ("last", [("a", None, 10), ("b", "X", 2), ("c", "X", 30)]),
    ],
)
def test_merge_base_with_null_key_parts(spark, policy, expected):
    schema = "category STRING, country STRING, n INT, run_seq INT, batch_id BIGINT"
    base = spark.createDataFrame([("a", None, 1, 1, 0), ("b", "X", 2, 1, 0)], schema)
    tail = spark.createDataFrame([("a", None, 10, 1, 1), ("c", "X", 30, 1, 1)], schema)
    assert rows(merge_base(base, tail, ["category", "country"], policy).drop("run_seq", "batch_id")) == expected


@pytest.mark.parametrize(("policy", "expected"), [("first", 10), ("last", 1)])
def test_merge_base_with_an_earlier_tail(spark, policy, expected):
    schema = "id INT, n INT, run_seq INT, batch_id BIGINT"
    base = spark.createDataFrame([(1, 1, 1, 0)], schema)
    tail = spark.createDataFrame([(1, 10, 0, 7)], schema)
    assert merge_base(base, tail, ["id"], policy).collect()[0]["n"] == expected


def test_merge_base_unknown_policy(spark):
    frame = spark.createDataFrame([(1,)], "id INT")
    with pytest.raises(ValueError, match="policy"):
        merge_base(frame, frame, ["id"], "middle")


def test_batch_log(spark):
    store = BatchLog(spark, work_folder(spark, "log"), "id INT, value STRING")
    assert store.read().count() == 0 and store.batches() == []
    frame = spark.createDataFrame([(1, "a")], "id INT, value STRING")
    store.write(frame, 0, 0)
    store.write(frame, 0, 11)
    store.write(frame, 1, 0)
    store.write(frame.limit(0), 1, 1)
    before = rows(store.read())
    store.write(frame, 0, 11)
    assert rows(store.read()) == before == [(1, "a", 0, 0), (1, "a", 0, 11), (1, "a", 1, 0)]
    assert store.batches() == [(0, 0), (0, 11), (1, 0), (1, 1)]
    assert rows(store.read(after={0: 0}), "run_seq", "batch_id") == [(0, 11), (1, 0)]
    assert rows(store.read(after={0: 0}, upto={0: 11}), "run_seq", "batch_id") == [(0, 11)]
    assert store.read(after={0: 11, 1: 1}).count() == 0


def test_tail_reads_only_later_folders(spark):
    store = BatchLog(spark, work_folder(spark, "log"), "id INT")
    for batch in range(3):
        store.write(spark.range(1).selectExpr("cast(id as int) id"), 0, batch)
    files = store.read(after={0: 1}).inputFiles()
    assert files and all("/run_seq=0/batch_id=2/" in f for f in files)


def test_run_numbers(spark):
    registry = RunRegistry(spark, work_folder(spark, "runs"))
    folder = work_folder(spark, "checkpoints")

    def checkpoint(name, query_id):
        spark.createDataFrame([(query_id,)], "id STRING").coalesce(1).write.json(f"{folder}/{name}/metadata")
        return f"{folder}/{name}"

    assert registry.run_for(f"{folder}/none") == (0, False)
    # Started together with the first: its number is taken although nothing is on record yet.
    first = checkpoint("a", "q-a")
    assert registry.run_for(first) == (1, False)
    registry.record("q-a", 1)
    assert registry.run_for(first) == (1, True)
    assert registry.run_for(checkpoint("b", "q-b")) == (2, False)
    assert registry.run_for(f"{folder}/none") == (3, False)
