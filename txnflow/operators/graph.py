"""The transaction graph as node and edge frames, and the queries over it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.operators.filters import APPROVED
from txnflow.operators.upsert import ORDER, first_write, keys_of, last_write, last_write_partial
from txnflow.schemas import CUSTOMER_COLUMNS, MERCHANT_COLUMNS

TRANSACTION_KEY = ("transaction_id",)
MADE_KEY = ("customer_id", "transaction_id")
AT_KEY = ("transaction_id", "merchant_id")
STATS_KEY = ("category", "country", "window_start")


# --- views of the raw log: one log row feeds three node labels and two edge types ---
def customer_stubs(raw_log: DataFrame) -> DataFrame:
    return keys_of(raw_log, ["customer_id"])


def merchant_rows(raw_log: DataFrame) -> DataFrame:
    return raw_log.select("merchant_id", F.col("merchant_category").alias("category"), *ORDER)


def merchant_stubs(raw_log: DataFrame) -> DataFrame:
    """Merchants by first sight; the category is whatever the first row carried."""
    return first_write(merchant_rows(raw_log), ["merchant_id"])


def transaction_rows(raw_log: DataFrame) -> DataFrame:
    return raw_log.select("transaction_id", "amount", "currency", "status", "transaction_date", *ORDER)


def transaction_nodes(raw_log: DataFrame) -> DataFrame:
    return first_write(transaction_rows(raw_log), TRANSACTION_KEY)


def made_rows(raw_log: DataFrame) -> DataFrame:
    return raw_log.select(
        "customer_id", "transaction_id", "amount", "currency", F.col("transaction_date").alias("timestamp"), *ORDER
    )


def made_edges(raw_log: DataFrame) -> DataFrame:
    return first_write(made_rows(raw_log), MADE_KEY)


def at_edges(raw_log: DataFrame) -> DataFrame:
    return keys_of(raw_log, AT_KEY)


# --- views with a second writer: seeding overwrites attributes, stubs add bare keys ---
def customer_seed_nodes(seed_log: DataFrame) -> DataFrame:
    return last_write_partial(seed_log, ["customer_id"], CUSTOMER_COLUMNS)


def merchant_seed_nodes(seed_log: DataFrame) -> DataFrame:
    return last_write_partial(seed_log, ["merchant_id"], MERCHANT_COLUMNS)


def seeded_and_stubs(seeded: DataFrame, stubs: DataFrame, key: str) -> DataFrame:
    """Seeded rows, and stubs of the keys that are not seeded; each frame holds a key once.

    A union by key rather than a full join: a filter on the key reaches both sides' scans.
    """
    attributes = [c for c in seeded.columns if c != key]
    both = seeded.withColumn("_seeded", F.lit(True)).unionByName(
        stubs.withColumn("_seeded", F.lit(False)), allowMissingColumns=True
    )
    if not attributes:
        return keys_of(both, [key])
    return both.groupBy(key).agg(*(F.max_by(c, "_seeded").alias(c) for c in attributes))


def customer_nodes(seed_log: DataFrame, raw_log: DataFrame) -> DataFrame:
    return seeded_and_stubs(customer_seed_nodes(seed_log), customer_stubs(raw_log), "customer_id")


def merchant_nodes(seed_log: DataFrame, raw_log: DataFrame) -> DataFrame:
    return seeded_and_stubs(merchant_seed_nodes(seed_log), merchant_stubs(raw_log), "merchant_id")


def stats_nodes(stats_log: DataFrame) -> DataFrame:
    return last_write(stats_log, STATS_KEY)


Maker = Callable[[], DataFrame]


class Graph:
    """Current nodes and edges; each table is planned when a query first asks for it."""

    def __init__(
        self, *, customers: Maker, merchants: Maker, transactions: Maker, made: Maker, at: Maker,
        category_stats: Maker,
    ):
        self._makers = {
            "customers": customers, "merchants": merchants, "transactions": transactions,
            "made": made, "at": at, "category_stats": category_stats,
        }

    @classmethod
    def from_logs(
        cls, raw_log: DataFrame, customer_seed: DataFrame, merchant_seed: DataFrame, stats_log: DataFrame
    ) -> Graph:
        return cls(
            customers=lambda: customer_nodes(customer_seed, raw_log),
            merchants=lambda: merchant_nodes(merchant_seed, raw_log),
            transactions=lambda: transaction_nodes(raw_log),
            made=lambda: made_edges(raw_log),
            at=lambda: at_edges(raw_log),
            category_stats=lambda: stats_nodes(stats_log),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._makers["customers"]()

    @cached_property
    def merchants(self) -> DataFrame:
        return self._makers["merchants"]()

    @cached_property
    def transactions(self) -> DataFrame:
        return self._makers["transactions"]()

    @cached_property
    def made(self) -> DataFrame:
        return self._makers["made"]()

    @cached_property
    def at(self) -> DataFrame:
        return self._makers["at"]()

    @cached_property
    def category_stats(self) -> DataFrame:
        return self._makers["category_stats"]()

    def labels(self) -> dict[str, DataFrame]:
        return {
            "Customer": self.customers,
            "Merchant": self.merchants,
            "Transaction": self.transactions,
            "CategoryStats": self.category_stats,
        }


def label_counts(graph: Graph) -> DataFrame:
    """Nodes per label, largest first; a label without nodes counts 0."""
    counts = [
        nodes.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(label).alias("label"), "cnt")
        for label, nodes in graph.labels().items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("cnt"), "label")


def relationship_count(graph: Graph) -> DataFrame:
    counts = [edges.agg(F.count(F.lit(1)).alias("cnt")) for edges in (graph.made, graph.at)]
    return reduce(DataFrame.unionByName, counts).agg(F.sum("cnt").alias("rels"))


def top_customers(graph: Graph, status: str = APPROVED, n: int = 1) -> DataFrame:
    """Customers with the most transactions of a status, ties broken by id.

    Edges are counted per customer before the names are joined, so the second join handles
    one row per customer.
    """
    wanted = graph.transactions.where(F.col("status") == status).select("transaction_id")
    counts = (
        graph.made.select("customer_id", "transaction_id")
        .join(wanted, "transaction_id")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("approved_count"))
    )
    names = graph.customers.select("customer_id", F.col("customer_name").alias("name"))
    return (
        counts.join(names, "customer_id")
        .select("customer_id", "name", "approved_count")
        .orderBy(F.desc("approved_count"), "customer_id")
        .limit(n)
    )


def _paths_along(graph: Graph, edges: list[tuple[int, int]]) -> DataFrame:
    """Paths on a few known MADE edges. Their keys are literals, so each table is cut to them before it is resolved."""
    customers, transactions = (sorted(set(ids)) for ids in zip(*edges, strict=True))
    of_transaction = F.col("transaction_id").isin(transactions)
    made = graph.made.select("customer_id", "transaction_id").where(
        of_transaction & F.struct("customer_id", "transaction_id").isin([
            F.struct(F.lit(c).cast("long").alias("customer_id"), F.lit(t).cast("long").alias("transaction_id"))
            for c, t in edges
        ])
    )
    return (
        made.join(graph.transactions.where(of_transaction).select("transaction_id"), "transaction_id", "left_semi")
        .join(graph.customers.where(F.col("customer_id").isin(customers)).select("customer_id"), "customer_id", "left_semi")
        .join(graph.at.where(of_transaction), "transaction_id")
        .join(graph.merchants.select("merchant_id"), "merchant_id", "left_semi")
        .select("customer_id", "transaction_id", "merchant_id")
    )


def transaction_paths(graph: Graph, n: int = 25) -> DataFrame:
    """The first ``n`` Customer-MADE->Transaction-AT->Merchant paths by the ids along them.

    A transaction id used again has several edges on both sides. The first ``n`` paths lie on
    the first ``n`` MADE edges that lead anywhere. So the first edges are taken by their keys
    alone, and only they are followed; should some lead nowhere, more are taken after them.
    """
    by_key, wanted = ("customer_id", "transaction_id"), n
    along, found = (*by_key, "merchant_id"), []
    rest = graph.made.select(*by_key).where("customer_id is not null and transaction_id is not null")
    while True:
        edges = [tuple(row) for row in rest.orderBy(*by_key).limit(wanted).collect()]
        if edges:
            found += _paths_along(graph, edges).orderBy(*along).limit(n).collect()
        if len(edges) < wanted or len(found) >= n:
            break
        customer, transaction = edges[-1]
        rest = rest.where((F.col("customer_id") >= customer) & (
            (F.col("customer_id") > customer) | (F.col("transaction_id") > transaction)))
        wanted *= 4
    ids = ", ".join(f"{c} BIGINT" for c in along)
    return graph.made.sparkSession.createDataFrame(found, ids).orderBy(*along).limit(n)


def path_details(graph: Graph, paths: DataFrame) -> DataFrame:
    """Node and edge properties for a report of a few paths, which are listed first."""
    rows = paths.collect()
    listed = paths.sparkSession.createDataFrame(rows, paths.schema)

    def along(table: DataFrame, key: str) -> DataFrame:
        """Cut to the paths' keys before the table is resolved."""
        return table.where(F.col(key).isin(sorted({row[key] for row in rows})))

    made = graph.made.select(
        "customer_id", "transaction_id", F.col("amount").alias("made_amount"),
        F.col("currency").alias("made_currency"), F.col("timestamp").alias("made_timestamp"),
    )
    return (
        listed.join(along(made, "transaction_id"), ["customer_id", "transaction_id"])
        .join(along(graph.transactions, "transaction_id"), "transaction_id")
        .join(along(graph.customers, "customer_id"), "customer_id")
        .join(along(graph.merchants, "merchant_id"), "merchant_id")
    )
