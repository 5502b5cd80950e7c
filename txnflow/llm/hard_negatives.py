"""Hard negatives by exact scores, computed with subset-sum tables (Four Russians).

Vectors are scaled and floored to integers. Of a block of anchors, the sums over all subsets
of each eight dimensions are tabulated once. A candidate's integers are cut into bit planes
of two's complement, eight dimensions to a byte, so a byte looks up what its plane adds to
every anchor's score; looked-up rows are added over the groups of dimensions, shifted by
their plane, and added up. The sign plane counts negatively. Scores are whole and exact.

Anchors stand in blocks of about ``anchors_per_block`` rows, candidates in chunks of a few
blocks of at most ``rows_per_block``. Each chunk meets each anchor block in a group of its own,
in each of two rounds: the first finds the best rows of the anchor's own label, the second
the best rows of other labels whose score lies in the range that each of those sets. A group
returns its best only, and a ranked window takes the best of all groups.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component,
take no part; nor do those with a scaled component of 2^24 or more, whose scores a long might
not hold. Vectors of different lengths are compared as if the shorter ended in zeros.
Repeated rows each take part; an anchor's other rows are those of another vec_id, and rows
that tie in score and vec_id are interchangeable. An empty table has no rows to return. Other
input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.session import work_folder

_LIMIT = 1 << 24
_NOTHING, _NO_ID = np.iinfo(np.int64).min // 4, np.iinfo(np.int64).max
#: Anchors whose tables are looked up together, so that tables stay in a core's cache.
_COLUMNS = 256
_BLOCK = "part long, number int, n int, groups int, planes int, ids binary, labels binary, bits binary"
_ANCHORS = "anchor_block int, a_n int, a_dims int, a_ids binary, a_labels binary, a_values binary"

_POSITIVE = pa.schema([
    ("anchor_block", pa.int32()), ("anchor", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()),
    ("positive_score", pa.int64()),
])
_NEGATIVE = pa.schema([
    ("anchor_block", pa.int32()), ("asked", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64()),
])


@dataclass(frozen=True)
class MiningParams:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    #: A negative's score, in hundredths of the positive's.
    least_share: int = 30
    most_share: int = 90
    anchors_per_block: int = 1024
    rows_per_block: int = 4096
    blocks_per_chunk: int = 4


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and integer components of the rows that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(scale * x.cast("double")) < _LIMIT - 1))
    return (
        vectors.where("vec_id is not null and label is not null and embedding is not null").where(finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                F.transform(scaled, lambda x: x.cast("int")).alias("q"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Integers of a list column, the shorter lists padded with zeros to a multiple of eight."""
    sizes = np.diff(column.offsets.to_numpy())
    width = -(-int(sizes.max(initial=0)) // 8) * 8
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Two's complement planes of integers: (plane, row, byte of eight dimensions), the sign last."""
    spread = max(int(values.max(initial=0)), -1 - int(values.min(initial=0)))
    return np.stack([
        np.packbits((values >> b & 1).astype(np.uint8), axis=1, bitorder="little")
        for b in range(spread.bit_length() + 1)
    ])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of every subset of each eight dimensions: (group, subset, anchor)."""
    n, width = anchors.shape
    # Planes of all groups are added before they are shifted, so the type must hold a whole row's sum.
    most = int(np.abs(anchors.astype(np.int64)).sum(axis=1).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    out = np.zeros((width // 8, 256, n), kind)
    columns = anchors.T.reshape(width // 8, 8, n)
    for k in range(8):
        out[:, 1 << k : 2 << k] = out[:, : 1 << k] + columns[:, k, None].astype(kind)
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products (candidate, anchor) from tables and bit planes."""
    _, n, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), np.int64)
    part, looked = np.empty(total.shape, tables.dtype), np.empty(total.shape, tables.dtype)
    for b, plane in enumerate(planes):
        part[:] = 0
        for g in range(min(groups, len(tables))):
            np.take(tables[g], plane[:, g], axis=0, out=looked)
            part += looked
        shifted = part.astype(np.int64) << b
        total += -shifted if b == len(planes) - 1 else shifted
    return total


def _packed_candidates(rows_per_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_block):
                rows = batch.slice(at, rows_per_block)
                ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
                order = np.lexsort((ids, labels))
                planes = bit_planes(_matrix(rows.column("q"))[order])
                found = (
                    part, number, len(ids), planes.shape[2], len(planes), ids[order].tobytes(),
                    labels[order].tobytes(), planes.tobytes(),
                )
                number += 1
                yield _one_row(found, ("long", "int", "int", "int", "int", "bin", "bin", "bin"), _BLOCK)

    return run


def _packed_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    order = np.argsort(labels, kind="stable")
    values = _matrix(rows.column("q").chunk(0))[order]
    found = (
        TaskContext.get().partitionId(), len(ids), values.shape[1], ids[order].tobytes(), labels[order].tobytes(),
        values.tobytes(),
    )
    yield _one_row(found, ("int", "int", "int", "bin", "bin", "bin"), _ANCHORS)


def _one_row(values: tuple, kinds: tuple, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "bin": pa.binary()}
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], types[k]) for v, k in zip(values, kinds, strict=True)], names)


class _Best:
    """The best k (score, id) per row of a matrix, over what is added bit by bit."""

    def __init__(self, rows: int, k: int) -> None:
        self.scores = np.full((rows, k), _NOTHING, np.int64)
        self.ids = np.full((rows, k), _NO_ID, np.int64)

    def add(self, at: slice | np.ndarray, ranked: np.ndarray, ids: np.ndarray, begin: np.ndarray, least: np.ndarray) -> None:
        """Of ranked rows, what stands from ``begin`` on and reaches ``least``."""
        k, n = self.scores.shape[1], ranked.shape[1]
        place = begin[:, None] + np.arange(k)
        inside, place = place < n, np.minimum(place, n - 1)
        found = np.take_along_axis(ranked, place, axis=1)
        inside &= (found >= least[:, None]) & (found > _NOTHING)
        found, named = np.where(inside, found, _NOTHING), np.where(inside, np.take_along_axis(ids, place, axis=1), _NO_ID)
        both, named = np.hstack((self.scores[at], found)), np.hstack((self.ids[at], named))
        order = np.lexsort((named, -both), axis=1)[:, :k]
        self.scores[at] = np.take_along_axis(both, order, axis=1)
        self.ids[at] = np.take_along_axis(named, order, axis=1)


def _ranked(found: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's scores from the highest, ties by id, and their ids."""
    by_id = np.argsort(ids, kind="stable")
    order = by_id[np.argsort(-found[:, by_id], axis=1, kind="stable")]
    return np.take_along_axis(found, order, axis=1), ids[order]


class _Anchors:
    def __init__(self, row: dict) -> None:
        self.block, self.n = row["anchor_block"], row["a_n"]
        self.ids = np.frombuffer(row["a_ids"], np.int64)
        self.labels = np.frombuffer(row["a_labels"], np.int64)
        self.values = np.frombuffer(row["a_values"], np.int32).reshape(self.n, row["a_dims"])

    def spans(self, own_label: bool) -> Iterator[tuple[int, int, np.ndarray]]:
        """Columns that are scored together, of one label or any, and their tables."""
        edges = [0, self.n]
        if own_label:
            edges = [0, *(np.flatnonzero(np.diff(self.labels)) + 1).tolist(), self.n]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            for at in range(low, high, _COLUMNS):
                to = min(at + _COLUMNS, high)
                yield at, to, subset_sums(self.values[at:to])


def _candidates(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and bit planes of each candidate block."""
    for row in rows.to_pylist():
        planes = np.frombuffer(row["bits"], np.uint8).reshape(row["planes"], row["n"], row["groups"])
        yield np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), planes


def _positives(k: int):
    def run(block: pa.Table, rows: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _POSITIVE.empty_table()
        anchors = _Anchors(block.to_pylist()[0])
        best, blocks = _Best(anchors.n, k), list(_candidates(rows))
        for low, high, tables in anchors.spans(own_label=True):
            for ids, labels, planes in blocks:
                # Candidates stand by label, so those of one are a slice.
                a, b = (int(np.searchsorted(labels, anchors.labels[low], side)) for side in ("left", "right"))
                if a == b:
                    continue
                found = scores(tables, planes[:, a:b]).T
                found = np.where(ids[a:b] == anchors.ids[low:high, None], _NOTHING, found)
                none = np.zeros(high - low, np.int64)
                best.add(slice(low, high), *_ranked(found, ids[a:b]), none, none + _NOTHING)
        at, place = np.nonzero(best.scores > _NOTHING)
        return pa.Table.from_arrays(
            [pa.array(np.full(len(at), anchors.block, np.int32)), pa.array(at.astype(np.int32)),
             pa.array(anchors.ids[at]), pa.array(best.ids[at, place]), pa.array(best.scores[at, place])],
            schema=_POSITIVE,
        )

    return run


def _negatives(params: MiningParams):
    def run(block: pa.Table, rows: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _NEGATIVE.empty_table()
        row = block.to_pylist()[0]
        anchors = _Anchors(row)
        anchor = np.array([p["anchor"] for p in row["positives"]], np.int64)
        score = np.array([p["positive_score"] for p in row["positives"]], np.int64)
        # Shares round inwards: the bounds are the integers that satisfy them.
        most, least = params.most_share * score // 100, -(-params.least_share * score // 100)
        best, blocks = _Best(len(anchor), params.negatives), list(_candidates(rows))
        for low, high, tables in anchors.spans(own_label=False):
            asked = np.flatnonzero((anchor >= low) & (anchor < high))
            for ids, labels, planes in blocks if len(asked) else ():
                found = scores(tables, planes).T
                found = np.where(labels == anchors.labels[low:high, None], _NOTHING, found)
                ranked, named = _ranked(found, ids)
                for some in np.array_split(asked, -(-len(asked) // _COLUMNS)):
                    of = anchor[some] - low
                    begin = (ranked[of] > most[some, None]).sum(axis=1)
                    best.add(some, ranked[of], named[of], begin, least[some])
        at, place = np.nonzero(best.scores > _NOTHING)
        return pa.Table.from_arrays(
            [pa.array(np.full(len(at), anchors.block, np.int32)), pa.array(at.astype(np.int32)),
             pa.array(best.ids[at, place]), pa.array(best.scores[at, place])],
            schema=_NEGATIVE,
        )

    return run


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, params: MiningParams = MiningParams()) -> DataFrame:
    """Hard negatives for each anchor and positive.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition on them. A row's
    score is its inner product with the anchor in scaled integers, higher first, ties by
    vec_id. An anchor's positives are its best rows of the same label; each one's negatives
    are the best rows of other labels that score between the two shares of its score.
    """
    spark, folder = vectors.sparkSession, work_folder(vectors.sparkSession, "hard-negatives")
    rows = quantised(vectors.select("vec_id", "label", "embedding"), params.scale)
    rows.mapInArrow(_packed_candidates(params.rows_per_block), _BLOCK).write.parquet(f"{folder}/candidates")
    candidates = spark.read.schema(_BLOCK).parquet(f"{folder}/candidates")
    asked = quantised(vectors.where(is_anchor).select("vec_id", "label", "embedding"), params.scale)
    n_rows = candidates.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-asked.count() // params.anchors_per_block))
    # Dealt out in turn, so every block holds about as many anchors.
    asked.repartition(blocks).mapInArrow(_packed_anchors, _ANCHORS).write.parquet(f"{folder}/anchors")
    anchors = spark.read.schema(_ANCHORS).parquet(f"{folder}/anchors")

    chunks = max(1, -(-n_rows // (params.blocks_per_chunk * params.rows_per_block)))
    dealt = candidates.withColumn("chunk", F.pmod(F.xxhash64("part", "number"), F.lit(chunks))).withColumn(
        "anchor_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))

    def meet(of_anchors: DataFrame, run, schema: str) -> DataFrame:
        """Each chunk with each anchor block, in one group of a few blocks."""
        left = of_anchors.withColumn("chunk", every).groupBy("anchor_block", "chunk")
        return left.cogroup(dealt.groupBy("anchor_block", "chunk")).applyInArrow(run, schema)

    best = meet(
        anchors, _positives(params.positives),
        "anchor_block int, anchor int, anchor_id long, positive_id long, positive_score long",
    )
    by_score = Window.partitionBy("anchor_block", "anchor").orderBy(F.desc("positive_score"), "positive_id")
    (best.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= params.positives)
        .write.parquet(f"{folder}/positives"))
    positives = spark.read.parquet(f"{folder}/positives")
    listed = positives.groupBy("anchor_block").agg(
        F.array_sort(F.collect_list(F.struct("anchor", "place", "anchor_id", "positive_id", "positive_score"))).alias("positives")
    )
    listed.write.parquet(f"{folder}/listed")
    listed = spark.read.parquet(f"{folder}/listed")
    found = meet(
        anchors.join(listed, "anchor_block"), _negatives(params),
        "anchor_block int, asked int, negative_id long, negative_score long",
    )
    by_score = Window.partitionBy("anchor_block", "asked").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= params.negatives)
    named = listed.select("anchor_block", F.posexplode("positives").alias("asked", "p"))
    return ranked.join(named, ["anchor_block", "asked"]).select(
        F.col("p.anchor_id").alias("anchor_id"), F.col("p.positive_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("p.positive_score").alias("positive_score"), "negative_score",
    )
