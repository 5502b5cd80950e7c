"""SimHash near-duplicates through a byte-position inverted index.

A text's fingerprint has 64 bits in eight positional bytes. Fingerprints that differ in at
most d bits share at least 8 - d of them, so count filtering keeps the pairs whose tally of
shared positional bytes reaches that minimum. A posting list of one byte would hold a 256th of
all fingerprints, so the lists are intersected before pairs are made: a fingerprint is posted
under each choice of 8 - d positions, and a pair whose tally reaches the minimum shares at
least one such posting. Within a posting only the remaining d bytes can differ, and the bits
that do are counted exactly.

Equal fingerprints are one entry, so a posting has at most 256^d members however many copies
there are, and a posting yields a spanning set of links rather than all pairs.

Defined cases: a text without words (null, empty) has fingerprint zero, linked like any
other. Texts are read whole. Every row gets a row; a null doc_id never is a component's id
unless all its documents have none. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.components import connected_components
from txnflow.session import work_folder

_SEED = 42
_ROWS = "doc_id long, fp long, content long"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Posted entries (28 for each fingerprint at two bits, 24 bytes each) that one task makes.
_POSTED = 1_000_000
#: Postings up to this size compare their members directly; larger ones look up each neighbour.
_DIRECT = 64


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 3
    max_bits: int = 2


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the shingles' XXH64 bits; ties and texts without words give zeros."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], stops[: len(words) - shingle])).tolist()
    ends = (stops[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], _SEED) for a, b in zip(starts, ends, strict=True)])
    total, step = np.zeros(64, np.int64), 8 * 65_536
    for at in range(0, len(hashes), step):
        part = np.frombuffer(hashes[at : at + step], np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, content: Column | None = None) -> DataFrame:
    """doc_id, fingerprint (as a signed long) and ``content`` (a long) of every row; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64)), batch.column("content")],
                ["doc_id", "fp", "content"],
            )

    content = F.lit(None).cast("long") if content is None else content
    return docs.select("doc_id", "text", content.alias("content")).mapInArrow(run, _ROWS)


def position_masks(max_bits: int) -> list[int]:
    """Masks of the bytes kept by every choice of 8 - max_bits positions, as signed longs."""
    masks = []
    for kept in combinations(range(8), 8 - max_bits):
        mask = sum(0xFF << (8 * p) for p in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _links(members: np.ndarray, max_bits: int) -> np.ndarray:
    """(member, root) for each member linked, over links within the posting, to a smaller one."""
    members = np.unique(members)
    roots = members.copy()
    if len(members) <= _DIRECT:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= max_bits
        pairs = [np.nonzero(near)]
    else:
        differing = int(np.bitwise_or.reduce(members ^ members[0]))
        bits = [1 << b for b in range(64) if differing >> b & 1]
        flips = [sum(c) for n in range(1, max_bits + 1) for c in combinations(bits, n)]
        pairs = []
        for flip in flips:
            other = members ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(members, other), len(members) - 1)
            here = np.flatnonzero(members[at] == other)
            pairs.append((here, at[here]))
    while True:
        before = roots.copy()
        for a, b in pairs:
            np.minimum.at(roots, a, roots[b])
        # A root's own root is at most as large.
        roots = roots[np.searchsorted(members, roots)]
        if (roots == before).all():
            break
    moved = roots != members
    return np.stack((members[moved], roots[moved]))


def _posting_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((2, 0), np.uint64)]
            for posting in batch.column("members"):
                members = posting.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found.append(_links(members, max_bits))
            a, b = np.concatenate(found, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within ``max_bits`` of each other."""
    posted = F.explode(
        F.array(
            *(
                F.struct(F.lit(i).alias("positions"), F.col("fp").bitwiseAND(F.lit(mask)).alias("kept"))
                for i, mask in enumerate(position_masks(max_bits))
            )
        )
    )
    postings = (
        distinct.select("fp", posted.alias("p"))
        .groupBy("p.positions", "p.kept")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
    )
    return postings.select("members").mapInArrow(_posting_links(max_bits), "a long, b long")


def _components(
    docs: DataFrame, params: SimHashParams, content: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """doc_id, fp and content of every row, and of every fp its component's root and smallest doc_id."""
    spark = docs.sparkSession
    folder = work_folder(spark, "simhash")
    fingerprints(docs, params.shingle, content).write.parquet(f"{folder}/fingerprints")
    rows = spark.read.schema(_ROWS).parquet(f"{folder}/fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # The scan of the fingerprints is small, what is posted is not: its tasks are counted by that.
    tasks = -(-rows.count() * len(position_masks(params.max_bits)) // _POSTED)
    spread = distinct.select("fp").repartition(max(1, tasks), "fp")
    linked = connected_components(fingerprint_links(spread, params.max_bits), f"{folder}/components")
    rooted = distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the smallest doc_id reachable over links."""
    rows, named = _components(docs, params)
    return rows.join(named.drop("root"), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_survivors(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """One row of each component: of its smallest doc_id, or a null one if it has no other.

    Where several rows have that id, the one stays whose columns hash to the least. Survivors are
    chosen by id and hash; texts are fingerprinted once, and shuffled once to be fetched.
    """
    content = F.xxhash64(*docs.columns)
    rows, named = _components(docs, params, content)
    chosen = (
        rows.join(named, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "content").agg(F.count("*").alias("copies"), F.first("doc_id").alias("kept_id"))
        .groupBy("root").agg(F.min(F.struct("content", "copies", "kept_id")).alias("kept"))
        .select("root", F.col("kept.content").alias("kept_content"), "kept.copies", "kept.kept_id")
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("_content") == F.col("kept_content"))

    def fetched(wanted: DataFrame) -> DataFrame:
        return docs.withColumn("_content", content).join(wanted, same)

    # Only rows that stand there several times over have to be cut to one.
    row = F.first(F.struct(*docs.columns)).alias("row")
    repeated = fetched(chosen.where("copies > 1")).groupBy("root").agg(row)
    once = fetched(chosen.where("copies = 1")).select(*docs.columns)
    return once.unionByName(repeated.select(*(F.col("row")[c].alias(c) for c in docs.columns)))
