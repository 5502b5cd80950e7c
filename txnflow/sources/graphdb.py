"""Node tables as dimensions, and the option sets for a graph server behind a Spark connector.

The connector's jar is not needed to import this module; the readers and writers fail at
load time when it is missing.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONNECTOR_FORMAT = "org.neo4j.spark.DataSource"


@dataclass(frozen=True)
class GraphTarget:
    """Where and as whom to reach the graph server."""

    url: str
    user: str
    password: str
    database: str = "neo4j"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> GraphTarget:
        env = os.environ if env is None else env
        return cls(
            url=env["NEO4J_URI"],
            user=env["NEO4J_USER"],
            password=env["NEO4J_PASSWORD"],
            database=env.get("NEO4J_DATABASE", "neo4j"),
        )

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "authentication.type": "basic",
            "authentication.basic.username": self.user,
            "authentication.basic.password": self.password,
            "database": self.database,
        }

    def query_options(self, query: str, batch_size: int = 500) -> dict[str, str]:
        """Run a query for each row, which it sees as ``event``."""
        return {**self.options(), "query": query, "batch.size": str(batch_size)}


def _listed(columns: Sequence[str], name: str = "") -> str:
    sign = " = " if name else ": "
    return ", ".join(f"{name}{c}{sign}event.{c}" for c in columns)


def _by_key(name: str, label: str, keys: Sequence[str]) -> str:
    return f"({name}:{label} {{{_listed(keys)}}})"


def node_query(label: str, keys: Sequence[str], created: Sequence[str] = (), overwritten: Sequence[str] = ()) -> str:
    """Merge a node by its key: ``created`` columns are set when the server makes it, the others always."""
    query = f"MERGE {_by_key('n', label, keys)}"
    if created:
        query += f" ON CREATE SET {_listed(created, 'n.')}"
    if overwritten:
        query += f" SET {_listed(overwritten, 'n.')}"
    return query


def edge_query(edge: str, source: tuple[str, str], target: tuple[str, str], created: Sequence[str] = ()) -> str:
    """Merge an edge between two nodes the server has; ``created`` columns are set when it makes it."""
    ends = (_by_key(name, label, [key]) for name, (label, key) in (("a", source), ("b", target)))
    query = "".join(f"MATCH {end} " for end in ends) + f"MERGE (a)-[r:{edge}]->(b)"
    return query + (f" ON CREATE SET {_listed(created, 'r.')}" if created else "")


def read_nodes(spark: SparkSession, target: GraphTarget, label: str) -> DataFrame:
    return spark.read.format(CONNECTOR_FORMAT).options(**target.options()).option("labels", label).load()


@dataclass(frozen=True)
class ConnectorServer:
    """A graph server as the sinks need it: rows go in, and the server decides what is new."""

    target: GraphTarget

    def merge_nodes(
        self, rows: DataFrame, label: str, keys: Sequence[str], created: Sequence[str] = (),
        overwritten: Sequence[str] = (),
    ) -> None:
        self._run(rows, node_query(label, keys, created, overwritten))

    def merge_edges(
        self, rows: DataFrame, edge: str, source: tuple[str, str], target: tuple[str, str], created: Sequence[str] = (),
    ) -> None:
        self._run(rows, edge_query(edge, source, target, created))

    def merchants(self, spark: SparkSession) -> DataFrame:
        return merchant_dimension(read_nodes(spark, self.target, "Merchant"))

    def _run(self, rows: DataFrame, query: str) -> None:
        rows.write.format(CONNECTOR_FORMAT).mode("Append").options(**self.target.query_options(query)).save()


def merchant_dimension(merchants: DataFrame) -> DataFrame:
    """The two columns enrichment needs from any merchant table."""
    return merchants.select(F.col("merchant_id").cast("long").alias("merchant_id"), "category")
