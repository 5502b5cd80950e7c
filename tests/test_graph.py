import pytest
from helpers import rows
from pyspark.sql import functions as F

from txnflow.operators import graph as G
from txnflow.operators.quality import duplicate_keys, transactions_with_two_makers
from txnflow.operators.upsert import BatchLog
from txnflow.schemas import RAW_LOG, STATS_LOG
from txnflow.session import delete_folder, matching_paths, work_folder
from txnflow.streaming.store import GraphStore

RAW = f"{RAW_LOG}, run_seq INT, batch_id BIGINT"


def raw(spark, tuples):
    """(transaction, customer, merchant, amount, status) per row."""
    frame = spark.createDataFrame(tuples, "t BIGINT, c BIGINT, m BIGINT, a DOUBLE, s STRING")
    return frame.selectExpr(
        "t transaction_id", "c customer_id", "m merchant_id", "a amount", "'EUR' currency", "s status",
        "timestamp'2024-05-01 10:00:00' transaction_date", "cast(null as string) merchant_category",
    )


PEOPLE = "customer_id INT, customer_name STRING, email STRING, customer_country STRING, customer_city STRING, age INT, registration_date STRING"
SHOPS = "merchant_id INT, merchant_name STRING, category STRING, merchant_country STRING, merchant_city STRING"
FIRST = [(1, 1, 1, 5.0, "approved"), (2, 1, 2, 6.0, "approved"), (3, 2, 1, 7.0, "declined"), (4, 3, 9, 8.0, "approved"),
         (5, 3, 9, 9.0, "approved")]
SECOND = [(1, 2, 1, 50.0, "declined"), (6, 9, 1, 1.0, "approved")]


@pytest.fixture
def store(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    store.raw.write(raw(spark, FIRST), 0, 0)
    store.raw.write(raw(spark, SECOND), 0, 1)
    store.raw.write(raw(spark, SECOND).limit(0), 0, 2)
    store.seed_customers(spark.createDataFrame(
        [(i, f"n{i}", f"e{i}", "Spain", "Madrid", 30, "2020-02-29") for i in (1, 2, 3, 4)], PEOPLE))
    store.seed_merchants(spark.createDataFrame([(i, f"s{i}", "travel", "Spain", "Madrid") for i in (1, 2, 3)], SHOPS))
    return store


def brute_paths():
    log = FIRST + SECOND
    made = {(c, t) for t, c, *_ in log}
    at = {(t, m) for t, _, m, *_ in log}
    return sorted((c, t, m) for c, t in made for t2, m in at if t == t2)


def check_tables(graph):
    assert rows(graph.transactions, "transaction_id", "amount", "status") == [
        (1, 5.0, "approved"), (2, 6.0, "approved"), (3, 7.0, "declined"), (4, 8.0, "approved"),
        (5, 9.0, "approved"), (6, 1.0, "approved"),
    ]
    assert rows(graph.customers, "customer_id", "customer_name") == [
        (1, "n1"), (2, "n2"), (3, "n3"), (4, "n4"), (9, None)]
    assert rows(graph.merchants, "merchant_id", "category") == [(1, "travel"), (2, "travel"), (3, "travel"), (9, None)]
    log = FIRST + SECOND
    assert rows(graph.made, "customer_id", "transaction_id") == sorted({(c, t) for t, c, *_ in log})
    assert rows(graph.at) == sorted({(t, m) for t, _, m, *_ in log})


def check_graph(graph):
    check_tables(graph)
    assert [tuple(r) for r in G.transaction_paths(graph).collect()] == brute_paths()
    assert [tuple(r) for r in G.transaction_paths(graph, 2).collect()] == brute_paths()[:2]
    assert [tuple(r) for r in G.top_customers(graph, n=3).collect()] == [(1, "n1", 2), (3, "n3", 2), (2, "n2", 1)]
    assert [tuple(r) for r in G.label_counts(graph).collect()] == [
        ("Transaction", 6), ("Customer", 5), ("Merchant", 4), ("CategoryStats", 0)]
    assert rows(G.relationship_count(graph)) == [(13,)]
    assert rows(transactions_with_two_makers(graph)) == [("MADE", "1", 2)]
    assert duplicate_keys(graph.labels()).count() == 0
    details = G.path_details(graph, G.transaction_paths(graph, 1)).first()
    assert (details["made_amount"], details["customer_name"], details["category"]) == (5.0, "n1", "travel")


def test_graph_from_logs(store):
    check_graph(store.graph())


def test_paths_of_a_transaction_with_many_edges_on_both_sides(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    log = [(1, 100 - i, 50 - i, 1.0, "approved") for i in range(20)] + [(2, 1, 7, 1.0, "approved")]
    for batch, row in enumerate(log):
        store.raw.write(raw(spark, [row]), 0, batch)
    expected = sorted({(c, t, m) for t, c, *_ in log for t2, _, m, *_ in log if t == t2})
    graph = store.graph()
    for n in (1, 2, 25, 1000):
        assert [tuple(r) for r in G.transaction_paths(graph, n).collect()] == expected[:n]


def test_graph_after_compaction(store):
    store.compact_raw()
    assert store.base("raw_graph", "Transaction").marks == {0: 1}
    check_tables(store.graph())


def test_graph_with_base_and_later_batches(store):
    store.compact_raw(upto=(0, 0))
    check_graph(store.graph())
    before = store.base("raw_graph", "Transaction").parts
    store.compact_raw(upto=(0, 1))
    check_tables(store.graph())
    after = store.base("raw_graph", "Transaction")
    assert after.parts[:-1] == before and after.marks == {0: 1}


@pytest.mark.parametrize("done", [0, 1])
@pytest.mark.parametrize("failing", [1, 4])
def test_compaction_that_fails_between_its_tables(store, failing, done):
    """The first or second compaction dies after some of its tables, and is repeated."""
    if done:
        store.compact_raw(upto=(0, 0))
    attempts = []

    def die(base, rows, view):
        attempts.append(view)
        if len(attempts) > failing:
            raise RuntimeError("lost")
        return False

    broken = GraphStore(store.spark, store.root)
    object.__setattr__(broken, "_has_earlier", die)
    if done:
        with pytest.raises(RuntimeError, match="lost"):
            broken.compact_raw(upto=(0, 1))
    else:
        object.__setattr__(broken, "_record_bases", lambda *_: None)
        broken.compact_raw(upto=(0, 1))
    store.compact_raw(upto=(0, 1))
    check_tables(store.graph())


def test_an_older_run_goes_on_after_compaction(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    store.raw.write(raw(spark, [(1, 10, 20, 1.0, "approved")]), 0, 0)
    store.raw.write(raw(spark, [(2, 10, 20, 2.0, "approved"), (3, 10, 20, 30.0, "approved")]), 1, 0)
    store.raw.write(raw(spark, [(4, 10, 20, 4.0, "approved")]), 1, 1)
    for upto in (None, (9, 9)):
        store.compact_raw(upto)
        # A new key, and the first write of a known one.
        store.raw.write(raw(spark, [(77, 10, 20, 7.0, "approved"), (3, 10, 20, 3.0, "approved")]), 0, 1)
        want = [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (77, 7.0)]
        assert rows(store.graph().transactions, "transaction_id", "amount") == want
    store.compact_raw((9, 9))
    assert rows(store.graph().transactions, "transaction_id", "amount") == want
    assert store.base("raw_graph", "Transaction").marks == {0: 1, 1: 1}


def test_layout_changes_between_compactions(spark, store):
    store.compact_raw(upto=(0, 0))
    for i, buckets in enumerate((4, None, 2)):
        store.raw.write(raw(spark, [(100 + i, 1, 1, 1.0, "approved")]), 0, 10 + i)
        store.compact_raw(upto=(0, 10 + i), buckets=buckets, prefix="layout")
        assert store.graph().transactions.count() == 7 + i


def test_expiry_leaves_base_and_tail(spark, store):
    expected = rows(store.graph().transactions)
    for step in (0, 1):
        store.compact_raw(upto=(0, step))
    store.compact_raw(upto=(0, 1), buckets=2, prefix="expiring")
    store.expire("raw_graph")
    assert rows(store.graph().transactions) == expected
    assert (0, 0) not in store.raw.batches()
    listed = set(store.base("raw_graph", "Transaction").parts)
    on_disk = matching_paths(spark, f"{store.root}/raw_graph/base/Transaction/*")
    assert {p.split("/")[-1] for p in listed} <= {p.split("/")[-1] for p in on_disk}


def test_a_batch_being_written_is_not_read(spark, store):
    expected = rows(store.graph().transactions)
    folder = f"{store.raw.folder}/run_seq=5/batch_id=0/attempt=a"
    spark.createDataFrame([(99,)], "transaction_id long").write.parquet(folder)
    assert rows(store.graph().transactions) == expected


def test_readers_keep_the_earlier_attempt_while_a_batch_is_replayed(spark, store):
    before = store.raw.read()
    expected = rows(before)
    store.raw.write(raw(spark, FIRST), 0, 0)
    assert rows(before) == rows(store.raw.read()) == expected


MERCHANT = "merchant_id long, merchant_name string, category string, merchant_country string, merchant_city string"


def shop(spark, key, category):
    return spark.createDataFrame([(key, f"m{key}", category, "Spain", "Madrid")], MERCHANT)


def test_seeding_goes_on_after_a_crash(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    store.seed_merchants(shop(spark, 1, "travel"))
    # A seeding that took its number and died while writing.
    number = store.merchant_seed.claim()
    shop(spark, 9, "x").write.parquet(f"{store.merchant_seed.folder}/run_seq=0/batch_id={number}/attempt=a/_temporary/0")
    store.seed_merchants(shop(spark, 2, "health"))
    assert rows(store.merchant_dimension()) == [(1, "travel"), (2, "health")]


def test_seeders_at_once_take_numbers_of_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor

    store = GraphStore(spark, work_folder(spark, "graph"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: store.seed_merchants(shop(spark, k, f"c{k}")), range(4)))
    assert rows(store.merchant_dimension()) == [(k, f"c{k}") for k in range(4)]
    assert len(store.merchant_seed.batches()) == 4


def test_store_needs_no_success_markers(spark):
    options = spark.sparkContext._jsc.hadoopConfiguration()
    options.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store = GraphStore(spark, work_folder(spark, "graph"))
        store.seed_merchants(shop(spark, 1, "travel"))
        store.raw.write(raw(spark, FIRST), 0, 0)
        store.raw.write(raw(spark, SECOND), 0, 1)
        store.compact_raw()
        assert (1, "travel") in rows(store.graph().merchants, "merchant_id", "category")
        assert rows(store.merchant_dimension()) == [(1, "travel")]
    finally:
        options.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_expiry_after_two_compactions_at_once(spark):
    """Of two compactions with one number the later attempt counts; what only the other folded stays."""
    store = GraphStore(spark, work_folder(spark, "graph"))
    for i in range(4):
        store.raw.write(raw(spark, [(i, 10, 20, float(i), "approved")]), 0, i)
    store.compact_raw(upto=(0, 0))
    before = store._newest("raw_graph")
    store.compact_raw(upto=(0, 1))
    winner = max(r["attempt"] for r in store.compactions("raw_graph") if r["number"] == 1)
    # The loser folded more, and its attempt sorts first.
    entries = [(name, "", 0, list(row["parts"])) for name, row in before.items()]
    store._record_bases("raw_graph", before, "0" * 31, {0: 3}, entries)
    assert winner > "0" * 31
    expected = rows(store.graph().transactions)
    store.expire("raw_graph")
    assert rows(store.graph().transactions) == expected and len(expected) == 4
    assert store.raw.batches() == [(0, 1), (0, 2), (0, 3)]


def test_seeding_takes_one_row_of_a_repeated_key(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    seeds = [(1, "Zed", "travel", "Brazil", "Puebla"), (1, "Abe", "health", "Spain", "Madrid"), (1, "Mid", "zoo", "Canada", "Aaa")]
    store.seed_merchants(spark.createDataFrame(
        seeds, "merchant_id long, merchant_name string, category string, merchant_country string, merchant_city string"))
    assert rows(store.graph().merchants, "merchant_name", "category", "merchant_country", "merchant_city") == [
        ("Abe", "health", "Spain", "Madrid")]


def test_seeding_sends_bad_dates_to_the_rejects(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    seeds = [(1, "2024-02-29"), (2, "2024-02-30"), (3, None), (4, "soon")]
    store.seed_customers(spark.createDataFrame(seeds, "customer_id long, registration_date string"), ("registration_date",))
    assert [(r[0], str(r[1])) for r in rows(store.graph().customers, "customer_id", "registration_date")] == [
        (1, "2024-02-29"), (3, "None")]
    refused = BatchLog(spark, f"{store.customer_seed.root}_rejects", "row STRING").read().collect()
    assert sorted(r["row"] for r in refused) == [
        '{"customer_id":2,"registration_date":"2024-02-30"}', '{"customer_id":4,"registration_date":"soon"}']


def test_compaction_of_one_unfinished_batch_does_nothing(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    store.raw.write(raw(spark, FIRST), 0, 0)
    store.compact_raw()
    assert store.compactions("raw_graph") == []


def test_bucketed_bases_join_without_a_shuffle(spark, store):
    store.compact_raw(upto=(0, 0), buckets=4, prefix="bucketed")
    store.compact_raw(upto=(0, 2), buckets=4, prefix="bucketed")
    graph = store.graph()
    check_tables(graph)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = graph.made.join(graph.transactions, "transaction_id").join(graph.at, "transaction_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2


def test_seeding_overwrites_listed_columns(spark, store):
    store.seed_customers(spark.createDataFrame([(1, "Paris")], "customer_id INT, customer_city STRING"), ("customer_city",))
    store.seed_merchants(spark.createDataFrame([(9, "health")], "merchant_id INT, category STRING"), ("category",))
    graph = store.graph()
    assert rows(graph.customers.where("customer_id = 1"), "customer_name", "customer_city") == [("n1", "Paris")]
    assert rows(graph.merchants.where("merchant_id = 9"), "merchant_name", "category") == [(None, "health")]
    assert (9, "health") in rows(store.merchant_dimension())
    with pytest.raises(ValueError, match="columns"):
        store.seed_customers(graph.customers, ("nickname",))


def test_unseeded_merchants_keep_the_first_category(spark):
    store = GraphStore(spark, work_folder(spark, "graph"))
    first, later = raw(spark, FIRST[:1]), raw(spark, SECOND[:1]).withColumn("merchant_category", F.lit("late"))
    store.raw.write(first, 0, 0)
    store.raw.write(later, 0, 1)
    assert rows(store.graph().merchants, "merchant_id", "category") == [(1, None)]


def test_empty_store(spark):
    graph = GraphStore(spark, work_folder(spark, "empty")).graph()
    assert {tuple(r) for r in G.label_counts(graph).collect()} == {
        ("Transaction", 0), ("Customer", 0), ("Merchant", 0), ("CategoryStats", 0)}
    assert rows(G.relationship_count(graph)) == [(0,)]
    assert G.top_customers(graph).count() == 0


def stats(spark, tuples):
    frame = spark.createDataFrame(tuples, "category STRING, country STRING, at STRING, total_amount DOUBLE, txn_count BIGINT")
    return frame.selectExpr(
        "category", "country", "cast(at as timestamp) window_start",
        "cast(at as timestamp) + interval 1 minute window_end", "total_amount", "txn_count",
        "current_timestamp() updated_at",
    )


def test_stats_compaction_and_range_reads(spark):
    from datetime import datetime

    store = GraphStore(spark, work_folder(spark, "stats"))
    batches = [
        [("a", None, "2024-05-01 10:00:00", 1.0, 1), ("a", "X", "2024-05-02 10:00:00", 2.0, 1)],
        [("a", None, "2024-05-01 10:00:00", 5.0, 3), ("b", "X", "2024-05-03 10:00:00", 4.0, 1)],
        [("b", "X", "2024-05-03 10:00:00", 6.0, 2)],
    ]
    for i, batch in enumerate(batches):
        store.stats.write(stats(spark, batch), 0, i)
    expected = [("a", "X", 2.0, 1), ("a", None, 5.0, 3), ("b", "X", 6.0, 2)]
    columns = ("category", "country", "total_amount", "txn_count")
    since = datetime(2024, 5, 2, 12)
    for step in (None, (0, 0), (0, 1), None):
        assert rows(store.category_stats(), *columns) == expected
        assert rows(store.category_stats(since), *columns) == expected[2:]
        if step:
            store.compact_stats(step)
    plan = store.category_stats(since)._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(window_date" in plan and "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in plan
    assert set(store.category_stats().columns) == {c.split()[0] for c in STATS_LOG.split(",")}


def test_only_touched_days_are_written_anew(spark):
    store = GraphStore(spark, work_folder(spark, "stats"))
    days = [f"2024-05-0{d} 10:00:00" for d in (1, 2, 3)]
    store.stats.write(stats(spark, [("a", "X", at, 1.0, 1) for at in days]), 0, 0)
    store.compact_stats((0, 0))
    first = {p.rsplit("=", 1)[1]: p for p in store.base("category_stats", "category_stats").parts}
    store.stats.write(stats(spark, [("a", "X", days[1], 5.0, 2), ("b", "X", days[1], 1.0, 1)]), 0, 1)
    store.compact_stats((0, 1))
    second = {p.rsplit("=", 1)[1]: p for p in store.base("category_stats", "category_stats").parts}
    assert [first[d] == second[d] for d in sorted(first)] == [True, False, True]
    store.expire("category_stats")
    want = [("a", "X", 1.0, 1), ("a", "X", 1.0, 1), ("a", "X", 5.0, 2), ("b", "X", 1.0, 1)]
    assert rows(store.category_stats(), "category", "country", "total_amount", "txn_count") == want
    assert store.stats.batches() == [(0, 1)]


def test_constraints_report_null_parts(spark):
    frame = spark.sql("select * from values ('a', null, 1), ('a', null, 1), ('b', 'X', 1) as t(category, country, window_start)")
    assert rows(duplicate_keys({"CategoryStats": frame})) == [("CategoryStats", '["a",null,"1"]', 2)]
