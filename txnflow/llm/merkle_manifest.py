"""A Merkle manifest of a dataset, rolled up as nested structs.

A document's leaf is the hash of its fields. Within a group (a language) leaves stand by
doc_id; their rank is cut into a block and binary digits. The digits are grouped away one by
one: each step pairs the nodes that differ in the last digit only, hashes them, and
nests them below their parent. What is left is one row per block that holds a whole subtree of
a bounded number of leaves. Block roots are nodes of the next rollup, until a group has one
root; the groups' roots, by language, are rolled up in the same way to the root of the dataset.

Proofs come from the nested structs: each level is exploded, and a child takes its sibling's
hash along. A block row gets the path above it by a grouping with it, from the top rollup
down; no join pairs nodes with siblings.

``H`` is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text.
While a level has several nodes, each two consecutive ones become their H, a last single one
its own H. A path lists what stands before and after the node at each step, so folding it
over a leaf gives the root.

Defined cases: null fields count as ``-``. A null language is a group, the first one; a null
doc_id stands before all others. Rows that tie in both stand by their leaf; repeated rows are
leaves of their own. Texts are hashed whole. An empty table has an empty manifest. Other
input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnflow.session import work_folder

#: Digits grouped away within a block of 2^BITS leaves.
BITS = 8
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """H of a document's fields, each as its byte count and value, or a dash; some may be changed."""

    def field(name: str) -> Column:
        text = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return _sha(*map(field, _FIELDS))


@dataclass(frozen=True)
class Manifest:
    """The folders of the stored rollups, lowest first: those of documents and of languages."""

    spark: SparkSession
    documents: tuple[str, ...]
    languages: tuple[str, ...]


def _ranked(nodes: DataFrame, order: tuple[str, ...], folder: str) -> DataFrame:
    """Nodes with their ``rank`` from 0 within ``grp`` and the group's size ``n``.

    Nodes are dealt out by range and sorted, so a large group spreads over many tasks. A row's
    place in its task is written with it; what precedes the task comes from the tasks' counts.
    """
    spark = nodes.sparkSession
    keys = ["grp", *order, "row"]
    (nodes.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
        .drop("row").write.parquet(folder))
    placed = spark.read.parquet(folder)
    parts = placed.groupBy("grp", "part").agg(F.count("*").alias("held"), F.min("place").alias("first"))
    by_part = Window.partitionBy("grp").orderBy("part")
    parts = parts.select(
        "grp", "part", "first",
        F.coalesce(F.sum("held").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("held").over(Window.partitionBy("grp")).alias("n"),
    )
    ranked = placed.join(parts, ["grp", "part"])
    return ranked.withColumn("rank", F.col("before") + F.col("place") - F.col("first")).drop(
        "part", "place", "first", "before"
    )


def _rolled_up(nodes: DataFrame, items: tuple[str, ...]) -> DataFrame:
    """Rows (grp, n, block, node) of nodes (grp, n, rank, hash, items); one shuffle.

    The digits of a block are grouped away in the order the rows are sorted in, so no step
    shuffles or sorts again.
    """
    digits = [f"d{k}" for k in range(BITS)]
    frame = nodes.select(
        "grp", "n", F.shiftright("rank", BITS).alias("block"),
        *(F.shiftright("rank", k).bitwiseAND(F.lit(1).cast("long")).alias(d) for k, d in enumerate(digits)),
        F.struct("hash", *items).alias("node"),
    )
    left = ["grp", "n", "block", *reversed(digits)]
    frame = frame.repartition("grp", "n", "block").sortWithinPartitions(*left)
    for k, digit in enumerate(digits):
        left.remove(digit)
        child = [F.max(F.when(F.col(digit) == d, F.col("node"))) for d in (0, 1)]
        frame = frame.groupBy(*left).agg(F.array_compact(F.array(*child)).alias("kids"))
        pair = F.sha2(F.array_join(F.transform("kids", lambda kid: kid["hash"]), ""), 256)
        # A lone node stays as it is where no other is left in its group.
        alone = F.col("kids")[0]["hash"]
        value = F.when(F.col("n") > 1 << k, pair).otherwise(alone)
        frame = frame.select(*left, F.struct(value.alias("hash"), "kids").alias("node"))
    return frame


def _below(kids: Column, pairs: Column):
    """A child and its path: what its parent's path begins with is its sibling, if it has one."""

    def child(kid: Column, i: Column) -> Column:
        before = F.when(i == 1, F.get(kids, F.lit(0))["hash"])
        after = F.when(i == 0, F.get(kids, F.lit(1))["hash"])
        step = F.struct(*(F.coalesce(x, F.lit("")).alias(n) for x, n in ((before, "before"), (after, "after"))))
        path = F.when(pairs, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        return F.struct(kid.alias("node"), path.alias("path"))

    return child


def _paths(blocks: DataFrame, items: tuple[str, ...]) -> DataFrame:
    """Each leaf of block rows (grp, n, node, path, ...) with its path to the root."""
    kept = [c for c in blocks.columns if c not in ("node", "path")]
    for k in reversed(range(BITS)):
        kids = F.col("node.kids")
        blocks = blocks.select(*kept, F.inline(F.transform(kids, _below(kids, F.col("n") > 1 << k))))
    return blocks.select(*kept, "node.hash", *(f"node.{i}" for i in items), "path")


def _roll(nodes: DataFrame, items: tuple[str, ...], folder: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Roll up until every group has one node; returns those and the folders of the rollups."""
    spark, folders = nodes.sparkSession, []
    while True:
        folders.append(f"{folder}-{len(folders)}")
        _rolled_up(nodes, items).write.parquet(folders[-1])
        roots = spark.read.parquet(folders[-1]).select("grp", "n", "block", F.col("node.hash").alias("hash"))
        if roots.where("block > 0").isEmpty():
            return roots, tuple(folders)
        left = F.ceil(F.col("n") / F.lit(1 << BITS)).cast("long")
        nodes = roots.select("grp", left.alias("n"), F.col("block").alias("rank"), "hash", F.col("block").alias("item"))
        items = ("item",)


def build_manifest(docs: DataFrame, folder: str | None = None, claimed: Column | None = None) -> Manifest:
    """Hash, rank and roll up ``docs`` into rollups stored below ``folder``.

    ``claimed`` is the leaf that another copy of a document has, null for that of the document;
    the audit folds it in place of the document's own.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "merkle")
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    # A null language sorts first; others keep the order of their bytes.
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaves = docs.select(group.alias("grp"), "doc_id", leaf().alias("hash"), claimed.alias("claimed"))
    # Written before it is dealt out by range, which samples: texts are hashed once.
    leaves.write.parquet(f"{folder}/leaves")
    ranked = _ranked(spark.read.parquet(f"{folder}/leaves"), ("doc_id", "hash"), f"{folder}/ranked")
    subroots, documents = _roll(ranked, ("doc_id", "claimed"), f"{folder}/documents")
    roots = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("item"), "hash")
    ranked = _ranked(roots, ("item",), f"{folder}/ranked-languages")
    return Manifest(spark, documents, _roll(ranked, ("item",), f"{folder}/languages")[1])


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, claimed, subroot, root and path (from the leaf up) of every document."""
    read = manifest.spark.read.parquet
    top = read(manifest.languages[-1])
    rows = top.select("grp", "n", F.col("node.hash").alias("root"), "node", F.array().cast(_PATH).alias("path"))
    for folder in (*reversed(manifest.languages[:-1]), None):
        above = _paths(rows, ("item",))
        if folder is not None:
            rows = _attached(read(folder), above.withColumnRenamed("item", "block"), ("root",))
    above = above.select(F.col("item").alias("grp"), F.lit(0).cast("long").alias("block"), "path", "root",
                         F.col("hash").alias("subroot"))
    for i, folder in enumerate(reversed(manifest.documents)):
        rows = _attached(read(folder), above, ("root", "subroot"))
        last = i == len(manifest.documents) - 1
        above = _paths(rows, ("doc_id", "claimed") if last else ("item",))
        above = above if last else above.withColumnRenamed("item", "block")
    return above.select("doc_id", F.col("hash").alias("leaf"), "claimed", "subroot", "root", "path")


def _attached(blocks: DataFrame, above: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """Block rows with the path above them; both share their group, so no join pairs them."""
    both = blocks.select("grp", "block", "n", "node").unionByName(
        above.select("grp", "block", "path", *carried), allowMissingColumns=True
    )
    firsts = (F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", *carried))
    return both.groupBy("grp", "block").agg(*firsts).drop("block")


def audit(manifest: Manifest) -> DataFrame:
    """Every document's proof, folded over the claimed leaf or else its own, against the root."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    folded = F.aggregate(
        "path", F.coalesce("claimed", "leaf"), lambda acc, s: _sha(s["before"], acc, s["after"])
    )
    return proofs(manifest).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
