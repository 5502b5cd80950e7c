"""Exact duplicates through an index of cuckoo filters that takes and gives up digests.

A row's digest is the SHA-256 of its whole text. The index keeps, by shard of the digest, the
live digests with the row that stays and the number of rows (the shard's content), and a
cuckoo filter over them. A digest the filter misses is new and needs no look at the content.
A hit is verified: each slot of the filter names the stored digest it stands for, and only an
equal one counts. When a digest finds no slot, the filter is made twice as large and filled
again from the stored digests. Rows that are deleted leave their digest's count, and a digest
without rows leaves filter and content.

Tasks combine the rows of a batch by digest before anything is shuffled, so a text that a third
of all rows share reaches its shard as one row per batch. Shards are sized by the number of
rows, and hold a bounded number of digests whichever texts there are.

Defined cases: a null text counts as empty, and all empty texts are equal. Of equal texts the
row with the largest doc_id stays, a null doc_id only where there is no other; of rows
that tie, one stays. An empty table is an empty index. Texts are hashed whole inside the JVM.
Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.session import create_file, matching_paths

_ROWS = "doc_id long, row_id long, digest binary"
#: A digest with its largest row and a number of rows, added to what is stored or in its place.
_CHANGE = "shard int, digest binary, keep_id long, keep_row long, n long, replaces boolean"
_SLOTS, _ROUNDS = 4, 100
#: Rows for each shard of a new index, versions of an index.
ROWS_PER_SHARD, MOST_VERSIONS = 4096, 1024


class CuckooFilter:
    """Sixteen-bit prints of stored digests in buckets of four slots, two buckets to choose from."""

    def __init__(self, buckets: int) -> None:
        self.mask = np.uint64(buckets - 1)
        self.prints = np.zeros((buckets, _SLOTS), np.uint16)
        self.owners = np.full((buckets, _SLOTS), -1, np.int32)

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = np.maximum(digests[:, 1] & np.uint64(0xFFFF), 1).astype(np.uint16)
        return prints, (digests[:, 2] & self.mask).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The second bucket of a print in either of its two."""
        spread = (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & self.mask
        return at ^ spread.astype(np.int64)

    def find(self, digests: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """The stored digest each one equals, or -1; only slots whose print hits are compared."""
        prints, home = self._places(digests)
        found = np.full(len(digests), -1, np.int64)
        for at in (home, self._other(prints, home)):
            row, slot = np.nonzero(self.prints[at] == prints[:, None])
            owner = self.owners[at[row], slot]
            equal = (stored[owner] == digests[row]).all(axis=1)
            found[row[equal]] = owner[equal]
        return found

    def insert(self, numbers: np.ndarray, digests: np.ndarray) -> bool:
        """Give each stored digest a slot; False when one finds none."""
        prints, at = self._places(digests)
        numbers = numbers.astype(np.int32)
        for turn in range(_ROUNDS):
            for _ in range(2):
                free = self.prints[at] == 0
                slot = free.argmax(axis=1)
                # Of those that meet in a slot one goes in.
                target = np.where(free.any(axis=1), at * _SLOTS + slot, -1 - np.arange(len(at)))
                placed = np.zeros(len(at), bool)
                placed[np.unique(target, return_index=True)[1]] = True
                placed &= target >= 0
                self.prints.ravel()[target[placed]] = prints[placed]
                self.owners.ravel()[target[placed]] = numbers[placed]
                prints, at, numbers = prints[~placed], at[~placed], numbers[~placed]
                if not len(at):
                    return True
                at = self._other(prints, at)
            # Each changes places with the digest in one slot of its bucket.
            target = at * _SLOTS + (numbers + turn) % _SLOTS
            moved = np.unique(target, return_index=True)[1]
            target = target[moved]
            out_prints, out_numbers = self.prints.ravel()[target], self.owners.ravel()[target]
            self.prints.ravel()[target], self.owners.ravel()[target] = prints[moved], numbers[moved]
            full = out_prints > 0
            prints[moved[full]], numbers[moved[full]] = out_prints[full], out_numbers[full]
            at[moved[full]] = self._other(out_prints[full], at[moved[full]])
            left = np.ones(len(at), bool)
            left[moved[~full]] = False
            prints, at, numbers = prints[left], at[left], numbers[left]
            if not len(at):
                return True
        return False

    def delete(self, numbers: np.ndarray) -> None:
        gone = np.isin(self.owners, numbers)
        self.prints[gone], self.owners[gone] = 0, -1


class Shard:
    """The live digests of a shard, their rows, and the filter over them."""

    def __init__(self) -> None:
        self.digests = np.zeros((0, 4), np.uint64)
        #: Whether the staying row has a doc_id, that doc_id, its row, and the number of rows.
        self.rows = np.zeros((0, 4), np.int64)
        self.filter = CuckooFilter(64)

    @classmethod
    def load(cls, content: pa.Table, stored: dict) -> Shard:
        shard = cls()
        content = content.sort_by("number")
        shard.digests, shard.rows = _digests(content.column("digest")), _values(content, "group_size")
        shard.filter = CuckooFilter(stored["buckets"])
        shape = shard.filter.prints.shape
        shard.filter.prints = np.frombuffer(stored["prints"], np.uint16).reshape(shape).copy()
        shard.filter.owners = np.frombuffer(stored["owners"], np.int32).reshape(shape).copy()
        return shard

    def merge(self, digests: np.ndarray, rows: np.ndarray) -> None:
        """Add rows of digests that do not repeat within the call."""
        known = self.filter.find(digests, self.digests)
        hit = known >= 0
        self.rows[known[hit]] = _larger(self.rows[known[hit]], rows[hit])
        numbers = len(self.digests) + np.arange(int((~hit).sum()))
        self.digests = np.concatenate((self.digests, digests[~hit]))
        self.rows = np.concatenate((self.rows, rows[~hit]))
        if not self.filter.insert(numbers, self.digests[numbers]):
            self._resize()

    def replace(self, digests: np.ndarray, rows: np.ndarray) -> None:
        """Set the rows of known digests; those without rows leave."""
        known = self.filter.find(digests, self.digests)
        known, rows = known[known >= 0], rows[known >= 0]
        self.rows[known] = rows
        self.filter.delete(known[rows[:, 3] <= 0])

    def _resize(self) -> None:
        live = np.flatnonzero(self.rows[:, 3] > 0)
        buckets = 2 * len(self.filter.prints)
        while buckets * _SLOTS < len(live):
            buckets *= 2
        while True:
            self.filter = CuckooFilter(buckets)
            if self.filter.insert(live, self.digests[live]):
                return
            buckets *= 2

    def compact(self) -> None:
        """Forget the digests that have left; slots name the rest by their new numbers."""
        live = self.rows[:, 3] > 0
        new = np.where(live, np.cumsum(live) - 1, -1).astype(np.int32)
        held = self.filter.owners >= 0
        self.filter.owners[held] = new[self.filter.owners[held]]
        self.digests, self.rows = self.digests[live], self.rows[live]


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 4)


def _values(rows: pa.Table, count: str) -> np.ndarray:
    """Whether the staying row has a doc_id, that doc_id, its row, and a number of rows."""
    ids = rows.column("keep_id").combine_chunks()
    named = [ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()]
    return np.stack([*named, rows.column("keep_row").to_numpy(), rows.column(count).to_numpy()], axis=1).astype(np.int64)


def _larger(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two rows each that stay, the larger by (has a doc_id, doc_id, row); numbers add up."""
    take = np.zeros(len(a), bool)
    tie = np.ones(len(a), bool)
    for k in range(3):
        take |= tie & (b[:, k] > a[:, k])
        tie &= b[:, k] == a[:, k]
    out = np.where(take[:, None], b, a)
    out[:, 3] = a[:, 3] + b[:, 3]
    return out


def _combined(digests: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per digest: the largest that stays, and the sum of the numbers."""
    order = np.lexsort((*rows[:, 2::-1].T, *digests.T))
    digests, rows = digests[order], rows[order]
    begins = np.flatnonzero(np.append(True, (digests[1:] != digests[:-1]).any(axis=1))) if len(order) else order
    out = rows[np.append(begins[1:], len(order)) - 1] if len(order) else rows
    if len(order):
        out[:, 3] = np.add.reduceat(rows[:, 3], begins)
    return digests[begins], out


def _columns(digests: np.ndarray, rows: np.ndarray) -> list[pa.Array]:
    raw = digests.astype(">u8").tobytes()
    binary = pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary())
    return [binary, pa.array(rows[:, 1], mask=rows[:, 0] == 0), pa.array(rows[:, 2]), pa.array(rows[:, 3])]


def _combine_batches(shards: int):
    """Rows of one batch with the same digest become one change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.table({
                "digest": batch.column("digest"), "keep_id": batch.column("doc_id"), "keep_row": batch.column("row_id"),
                "n": pa.array(np.ones(batch.num_rows, np.int64)),
            })
            digests, rows = _combined(_digests(table.column("digest")), _values(table, "n"))
            shard = pa.array((digests[:, 0] % np.uint64(shards)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [shard, *_columns(digests, rows), pa.array(np.zeros(len(rows), bool))],
                ["shard", "digest", "keep_id", "keep_row", "n", "replaces"],
            )

    return run


#: ``number`` is a digest's place in its shard, by which the slots of the filter name it.
_STATE = pa.schema([
    ("shard", pa.int32()), ("number", pa.int32()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
    ("group_size", pa.int64()), ("buckets", pa.int32()), ("prints", pa.binary()), ("owners", pa.binary()),
])
_STATE_DDL = (
    "shard int, number int, digest binary, keep_id long, keep_row long, group_size long, "
    "buckets int, prints binary, owners binary"
)


def _next_state(key: tuple, stored: pa.Table, changes: pa.Table) -> pa.Table:
    """A shard's content, a row per digest, and one row with its filter."""
    filters = stored.filter(stored.column("prints").is_valid()).to_pylist()
    shard = Shard.load(stored.filter(stored.column("digest").is_valid()), filters[0]) if filters else Shard()
    replaces = changes.column("replaces").to_numpy()
    digests, rows = _digests(changes.column("digest")), _values(changes, "n")
    added = np.flatnonzero(~replaces)
    for at in range(0, len(added), ROWS_PER_SHARD):
        some = added[at : at + ROWS_PER_SHARD]
        shard.merge(*_combined(digests[some], rows[some]))
    shard.replace(digests[replaces], rows[replaces])
    shard.compact()
    n, number = len(shard.digests), key[0].as_py()
    places = pa.array(np.arange(n, dtype=np.int32))
    content = [pa.array([number] * n, pa.int32()), places, *_columns(shard.digests, shard.rows)]
    whole = content + [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())]
    head = [pa.array([number], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), *(pa.nulls(1, pa.int64()) for _ in range(3))]
    head += [pa.array([len(shard.filter.prints)], pa.int32())]
    head += [pa.array([a.tobytes()], pa.binary()) for a in (shard.filter.prints, shard.filter.owners)]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(c, schema=_STATE) for c in (whole, head)])


@dataclass(frozen=True)
class DigestIndex:
    """An index of live digests in a folder all executors reach; each change is a new version.

    A version holds the rows it added or took away, and the state of the shards it touched. It
    counts once its marker is there; what a failed change left is overwritten by the next.
    """

    spark: SparkSession
    folder: str

    def _versions(self) -> list[tuple[int, int]]:
        """Finished versions and the number of shards, oldest first."""
        found = matching_paths(self.spark, f"{self.folder}/done/*")
        return sorted(tuple(map(int, path.rsplit("/", 1)[1].split("-"))) for path in found)

    def _read(self, kind: str, schema: str) -> DataFrame:
        """What the finished versions wrote of a kind, with the version."""
        paths = [f"{self.folder}/{kind}/version={v}" for v, _ in self._versions()]
        schema = f"{schema}, version int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{kind}").parquet(*paths)

    def _state(self) -> DataFrame:
        """The newest state of each shard."""
        state = self._read("state", _STATE_DDL)
        newest = state.where("prints is not null").groupBy("shard").agg(F.max("version").alias("version"))
        return state.join(newest, ["shard", "version"]).drop("version")

    def rows(self) -> DataFrame:
        """doc_id, row_id and digest of the live rows."""
        gone = self._read("deleted", "row_id long").select("row_id")
        return self._read("rows", _ROWS).drop("version").join(gone, "row_id", "left_anti")

    def content(self) -> DataFrame:
        """The live digests, the row that stays of each, and the number of rows."""
        return self._state().where("digest is not null").select("digest", "keep_id", "keep_row", "group_size")

    def _next(self) -> tuple[int, int | None]:
        versions = self._versions()
        if len(versions) == MOST_VERSIONS:
            raise ValueError("the index has as many versions as its row numbers allow: build it anew")
        return (versions[-1][0] + 1, versions[-1][1]) if versions else (0, None)

    def _write(self, rows: DataFrame, kind: str, version: int) -> DataFrame:
        path = f"{self.folder}/{kind}/version={version}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _change(self, changes: DataFrame, version: int, shards: int) -> None:
        """Bring the touched shards to their next state; the others are not read."""
        changes = self._write(changes, "changes", version)
        stored = self._state().join(changes.select("shard").distinct(), "shard", "left_semi")
        state = stored.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(_next_state, _STATE_DDL)
        self._write(state, "state", version)
        create_file(self.spark, f"{self.folder}/done/{version}-{shards}")

    def insert(self, docs: DataFrame) -> None:
        """Add the rows of ``docs`` (doc_id, text)."""
        version, shards = self._next()
        digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
        # Row numbers of all versions differ, for up to a million tasks each.
        number = F.monotonically_increasing_id() * MOST_VERSIONS + version
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row_id"), digest.alias("digest"))
        rows = self._write(rows, "rows", version)
        self._write(self.spark.createDataFrame([], "row_id long"), "deleted", version)
        shards = shards or max(1, -(-rows.count() // ROWS_PER_SHARD))
        self._change(rows.mapInArrow(_combine_batches(shards), _CHANGE), version, shards)

    def delete(self, ids: DataFrame) -> None:
        """Take away the live rows whose doc_id is in ``ids`` (doc_id)."""
        version, shards = self._next()
        if shards is None:
            return
        live = self.rows()
        gone = live.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
        gone = self._write(gone.select("row_id", "digest"), "leaving", version)
        self._write(gone.select("row_id"), "deleted", version)
        self._write(self.spark.createDataFrame([], _ROWS), "rows", version)
        touched = gone.select("digest").distinct()
        left = live.join(gone.select("row_id"), "row_id", "left_anti").join(touched, "digest", "left_semi")
        left = left.groupBy("digest").agg(F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count("*").alias("n"))
        shard = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(shards))
        changes = touched.join(left, "digest", "left").select(
            shard.cast("int").alias("shard"), "digest", F.col("keep.doc_id").alias("keep_id"),
            F.coalesce("keep.row_id", F.lit(0)).cast("long").alias("keep_row"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.lit(True).alias("replaces"),
        )
        self._change(changes, version, shards)

    def groups(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept and text_sha256 of every live row.

        At most a thousand digests can each hold more than a thousandth of the rows. Their
        rows meet them in a broadcast; the others are joined by digest.
        """
        rows, content = self.rows(), self.content()
        total = content.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
        heavy = F.col("group_size") * 1000 > total
        often = F.broadcast(content.where(heavy))
        rest = rows.join(often.select("digest"), "digest", "left_anti").join(content.where(~heavy), "digest")
        return rows.join(often, "digest").unionByName(rest).select(
            "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
