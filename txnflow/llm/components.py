"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EDGES = "a long, b long"


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) but the roots; a root is its component's least node.

    Each round is written below ``folder``, so a lost executor costs the running round only.
    Rounds go on until the edges no longer change. No node's neighbours are ever gathered: a
    round is an aggregate, whose parts combine before the shuffle, and a join that can split
    a hot node.
    """
    spark = edges.sparkSession

    def stored(frame: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        frame.where("a <> b").distinct().write.parquet(f"{folder}/{name}")
        frame = spark.read.schema(_EDGES).parquet(f"{folder}/{name}")
        state = frame.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("b")).first()
        return frame, tuple(state)

    edges, state = stored(edges.select("a", "b"), "round-0")
    number = 0
    while state[0]:
        number += 1
        edges, new_state = stored(_small_star(_large_star(edges)), f"round-{number}")
        if new_state == state:
            break
        state = new_state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
