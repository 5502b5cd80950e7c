"""Keyed upserts on plain files: a log of batches, resolved to one row per key when read.

Each micro-batch has a folder ``run_seq=<k>/batch_id=<n>``, and each attempt at it a folder in
there that counts once its marker is written. So a replayed batch replaces itself, readers
have the earlier attempt until the later one is whole, and nothing is ever updated in place. Reading picks the first or the last
row per key by ``(run_seq, batch_id)``. Compaction folds finished batches into a base with one
row per key, which keeps where each row came from: a batch that arrives later from an older
run can then still come before it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.session import create_file, delete_folder, matching_paths, path_exists

RUN, BATCH = "run_seq", "batch_id"
ORDER = (RUN, BATCH)
_MARKER = re.compile(rf"/{RUN}=(\d+)/{BATCH}=(\d+)/_written-(\d+)-(\w+)$")


def _pick_columns(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], chooser, extreme, keep_order: bool
) -> DataFrame:
    # One aggregate per column rather than one over a whole-row struct: the optimizer drops
    # those a query does not use, so counting or testing one attribute shuffles no other.
    # The partial aggregate leaves one row per key and task, however hot the key.
    by = F.struct(*order)
    values = [c for c in rows.columns if c not in keys and c not in order]
    if not values and not keep_order:
        return keys_of(rows, keys)
    places = [extreme(by)[c].alias(c) for c in order] if keep_order else []
    return rows.groupBy(*keys).agg(*(chooser(c, by).alias(c) for c in values), *places)


def first_write(
    log: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, *, keep_order: bool = False
) -> DataFrame:
    """Create-only upsert: the earliest row of each key stays.

    A batch holds one row per key, as the writers see to; so ``order`` never ties.
    ``keep_order`` adds the order columns of the row that stayed.
    """
    return _pick_columns(log, keys, order, F.min_by, F.min, keep_order)


def last_write(
    log: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, *, keep_order: bool = False
) -> DataFrame:
    """Overwriting upsert: the latest row of each key stays, under the same condition."""
    return _pick_columns(log, keys, order, F.max_by, F.max, keep_order)


def last_write_partial(
    log: DataFrame, keys: Sequence[str], columns: Sequence[str], listed: str = "set_columns",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Overwrite only the columns each row lists in ``listed``; a listed NULL clears the value."""
    chosen = [
        F.max(F.when(F.array_contains(listed, c), F.struct(*order, c)))[c].alias(c) for c in columns
    ]
    return log.groupBy(*keys).agg(*chosen)


def keys_of(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Create-if-absent upsert of rows that are nothing but their key."""
    return log.select(*keys).distinct()


def dedup(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by the other columns in turn.

    The whole row is compared, so the survivor never depends on which task ran first.
    """
    values = [c for c in rows.columns if c not in keys and c not in order]
    smallest = F.min(F.struct(*order, *values)).alias("_row")
    kept = rows.groupBy(*keys).agg(smallest)
    return kept.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def _match_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str, nullable: bool) -> DataFrame:
    named = other.select(*(F.col(k).alias(f"_k_{k}") for k in keys))
    pairs = [rows[k].eqNullSafe(named[f"_k_{k}"]) if nullable else rows[k] == named[f"_k_{k}"] for k in keys]
    return rows.join(named, reduce(Column.__and__, pairs), how)


def only_new(tail: DataFrame, base: DataFrame, keys: Sequence[str], *, nullable: bool = True) -> DataFrame:
    """Rows of the tail whose key the base does not have. ``nullable`` makes NULL key parts compare equal."""
    return _match_keys(tail, base, keys, "left_anti", nullable)


def only_touched(rows: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``touched`` holds; NULL key parts compare equal."""
    return _match_keys(rows, touched, keys, "left_semi", True)


def merge_base(
    base: DataFrame, tail: DataFrame, keys: Sequence[str], policy: str, *, nullable: bool = True
) -> DataFrame:
    """One row per key from a base (one row per key) and resolved rows of other batches.

    Both carry the order columns, which decide between two rows of a key whichever side they
    are on; tables of bare keys carry none. Base rows whose key the tail lacks pass through.
    """
    if policy not in ("first", "last"):
        raise ValueError(f"unknown policy {policy!r}")
    tail = tail.select(*base.columns)
    if RUN not in base.columns:
        return base.unionByName(only_new(tail, base, keys, nullable=nullable))
    pick = first_write if policy == "first" else last_write
    touched = _match_keys(base, tail, keys, "left_semi", nullable)
    untouched = _match_keys(base, tail, keys, "left_anti", nullable)
    resolved = pick(touched.unionByName(tail), keys, keep_order=True)
    return untouched.unionByName(resolved.select(*base.columns))


Marks = dict[int, int]


@dataclass(frozen=True)
class BatchLog:
    """A folder of batches with a declared schema."""

    spark: SparkSession
    root: str
    schema: str

    @property
    def folder(self) -> str:
        return f"{self.root}/log"

    def _batch(self, run_seq: int, batch_id: int) -> str:
        return f"{self.folder}/{RUN}={run_seq}/{BATCH}={batch_id}"

    def write(self, rows: DataFrame, run_seq: int, batch_id: int) -> None:
        """Write a batch, or write it again: readers go over to the newest attempt with a marker."""
        folder, attempt = self._batch(run_seq, batch_id), uuid.uuid4().hex
        rows.write.parquet(f"{folder}/attempt={attempt}")
        number = len(matching_paths(self.spark, f"{folder}/_written-*"))
        create_file(self.spark, f"{folder}/_written-{number:06d}-{attempt}")

    def claim(self) -> int:
        """A batch number above all so far that no other writer gets; a crashed one's stays unused."""
        number = max((batch for _, batch in self.batches()), default=-1) + 1
        while not create_file(self.spark, f"{self.root}/claims/{number}"):
            number += 1
        return number

    def delete(self, run_seq: int, batch_id: int) -> None:
        delete_folder(self.spark, self._batch(run_seq, batch_id))

    def folders(self) -> dict[tuple[int, int], str]:
        """The newest finished attempt of each batch, oldest batch first."""
        found = {}
        for path in sorted(matching_paths(self.spark, f"{self.folder}/{RUN}=*/{BATCH}=*/_written-*")):
            run, batch, _, attempt = _MARKER.search(path).groups()
            found[int(run), int(batch)] = f"{path.rsplit('/', 1)[0]}/attempt={attempt}"
        return dict(sorted(found.items()))

    def batches(self) -> list[tuple[int, int]]:
        """The finished batches, oldest first, from folder names only."""
        return list(self.folders())

    def read(self, after: Marks | None = None, upto: Marks | None = None) -> DataFrame:
        """Finished batches: those above each run's mark in ``after`` and up to that in ``upto``.

        Only their folders are listed. Runs without a mark in ``after`` are read in full, those
        without one in ``upto`` not at all.
        """
        after = after or {}
        chosen = [
            path for (run, batch), path in self.folders().items()
            if batch > after.get(run, -1) and (upto is None or batch <= upto.get(run, -1))
        ]
        schema = f"{self.schema}, {RUN} INT, {BATCH} BIGINT"
        if not chosen:
            return self.spark.createDataFrame([], schema)
        files = self.spark.read.schema(f"{schema}, attempt STRING").option("basePath", self.folder)
        return files.parquet(*chosen).drop("attempt")


@dataclass(frozen=True)
class RunRegistry:
    """Numbers the checkpoints a sink has had, so batch 0 of a new one sorts after the old."""

    spark: SparkSession
    root: str

    @property
    def folder(self) -> str:
        return f"{self.root}/runs"

    def _known(self) -> dict[str, int]:
        if not path_exists(self.spark, self.folder):
            return {}
        rows = self.spark.read.schema("query_id STRING, run_seq INT").parquet(self.folder)
        return {row["query_id"]: row["run_seq"] for row in rows.collect()}

    def run_for(self, checkpoint: str) -> tuple[int, bool]:
        """The number of this checkpoint, and whether it is on record.

        A checkpoint without a record claims a free number, which no other start can get.
        """
        known = self._known()
        if path_exists(self.spark, f"{checkpoint}/metadata"):
            query_id = self.spark.read.schema("id STRING").json(f"{checkpoint}/metadata").first()["id"]
            if query_id in known:
                return known[query_id], True
        number = max(known.values(), default=-1) + 1
        while not create_file(self.spark, f"{self.root}/claims/{number}"):
            number += 1
        return number, False

    def record(self, query_id: str, run_seq: int) -> None:
        """Remember the number. A start that fails before this leaves its number unused."""
        row = self.spark.createDataFrame([(query_id, run_seq)], "query_id STRING, run_seq INT")
        row.coalesce(1).write.mode("append").parquet(self.folder)
