"""The graph store: batch logs of the sinks, their current views, and compaction."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow import schemas as S
from txnflow.functions.timetext import as_utc
from txnflow.operators import graph as G
from txnflow.operators.upsert import (
    BATCH, ORDER, RUN, BatchLog, Marks, RunRegistry, dedup, first_write, keys_of, last_write, merge_base, only_new,
)
from txnflow.operators.sizes import measured_bytes
from txnflow.operators.stats import category_spans, category_stats_by_merchant
from txnflow.session import create_file, delete_folder, matching_paths, path_exists

Position = tuple[int, int]


@dataclass(frozen=True)
class View:
    """How one current table comes out of a log: its columns, its key and which write stays."""

    columns: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    policy: str
    nullable: bool = False

    def resolve(self, log: DataFrame) -> DataFrame:
        """One row per key, with its place in the log unless the table is bare keys."""
        rows = self.columns(log)
        if set(rows.columns) == set(self.keys):
            return keys_of(rows, self.keys)
        return (first_write if self.policy == "first" else last_write)(rows, self.keys, keep_order=True)

    def merge(self, base: DataFrame, tail: DataFrame) -> DataFrame:
        return merge_base(base, tail, self.keys, self.policy, nullable=self.nullable)


@dataclass(frozen=True)
class Base:
    """A compacted table, what it is made of, and the last batch of each run folded into it."""

    rows: DataFrame
    parts: tuple[str, ...]
    table_name: str
    marks: Marks


@dataclass(frozen=True)
class Snapshot:
    """merchant_id and category of the merchants as of a version, and their measured size."""

    version: str
    rows: DataFrame
    size: int


RAW_VIEWS = {
    "Customer": View(G.customer_stubs, ("customer_id",), "first"),
    "Merchant": View(G.merchant_rows, ("merchant_id",), "first"),
    "Transaction": View(G.transaction_rows, G.TRANSACTION_KEY, "first"),
    "MADE": View(G.made_rows, G.MADE_KEY, "first"),
    "AT": View(G.at_edges, G.AT_KEY, "first"),
}
STATS_VIEWS = {"CategoryStats": View(lambda log: log, G.STATS_KEY, "last", nullable=True)}

_STATS_LOGS = {"category_stats": S.STATS_LOG, "merchant_stats": S.MERCHANT_STATS_LOG}
_DIMENSION = "merchant_id BIGINT, category STRING"
# Bases that join on the transaction are laid out by it, so those joins need no shuffle.
_BUCKET_KEYS = {
    "Customer": "customer_id", "Merchant": "merchant_id",
    "Transaction": "transaction_id", "MADE": "transaction_id", "AT": "transaction_id",
}
_BASE_SCHEMA = (
    "number BIGINT, attempt STRING, name STRING, table_name STRING, buckets INT, "
    "parts ARRAY<STRING>, marks MAP<INT, BIGINT>"
)


@dataclass(frozen=True)
class GraphStore:
    spark: SparkSession
    root: str

    def _log(self, sink: str, schema: str) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/{sink}", schema)

    @property
    def raw(self) -> BatchLog:
        return self._log("raw_graph", S.RAW_LOG)

    @property
    def rejects(self) -> BatchLog:
        return self._log("raw_graph_rejects", f"{S.WIDE_TRANSACTION}, kafka_ts TIMESTAMP")

    @property
    def stats(self) -> BatchLog:
        return self._log("category_stats", S.STATS_LOG)

    @property
    def merchant_stats(self) -> BatchLog:
        return self._log("merchant_stats", S.MERCHANT_STATS_LOG)

    @property
    def customer_seed(self) -> BatchLog:
        return self._log("customer_seed", S.CUSTOMER_SEED)

    @property
    def merchant_seed(self) -> BatchLog:
        return self._log("merchant_seed", S.MERCHANT_SEED)

    def runs(self, sink: str) -> RunRegistry:
        return RunRegistry(self.spark, f"{self.root}/{sink}")

    # --- seeding ---
    def seed_customers(self, rows: DataFrame, columns: tuple[str, ...] = S.CUSTOMER_COLUMNS) -> None:
        self._seed(self.customer_seed, rows, "customer_id", columns, S.CUSTOMER_COLUMNS)

    def seed_merchants(self, rows: DataFrame, columns: tuple[str, ...] = S.MERCHANT_COLUMNS) -> None:
        self._seed(self.merchant_seed, rows, "merchant_id", columns, S.MERCHANT_COLUMNS)

    def _seed(
        self, log: BatchLog, rows: DataFrame, key: str, columns: tuple[str, ...], known: tuple[str, ...]
    ) -> None:
        unknown = set(columns) - set(known)
        if unknown:
            raise ValueError(f"not columns of this table: {sorted(unknown)}")
        types = {f.name: f.dataType for f in log.read().schema.fields}
        values = [F.col(c).alias(c) if c in columns else F.lit(None).cast(types[c]).alias(c) for c in known]
        listed = F.array(*(F.lit(c) for c in columns)).cast("array<string>").alias("set_columns")
        # A key that repeats stands once, as one of its rows in full.
        rows = dedup(rows.select(F.col(key).cast("long").alias(key), *values), [key], ())
        typed = {c: F.col(c).try_cast(types[c]) for c in known}
        bad = reduce(Column.__or__, (F.col(c).isNotNull() & typed[c].isNull() for c in known))
        batch = log.claim()
        good = rows.where(~bad).select(key, *(typed[c].alias(c) for c in known), listed)
        log.write(good, 0, batch)
        refused = rows.where(bad).select(F.to_json(F.struct(*rows.columns)).alias("row"))
        if not refused.isEmpty():
            BatchLog(self.spark, f"{log.root}_rejects", "row STRING").write(refused, 0, batch)

    # --- the dimension as of a batch ---
    def merchant_snapshot(self, version: str | None = None) -> Snapshot:
        """The merchants' categories as seeded so far, resolved and measured once per version.

        A version is the set of seedings it is made of, so it never changes; ``version`` names
        an earlier one.
        """
        seeded = self.merchant_seed.folders()
        version = version or hashlib.sha256(repr([*seeded.values()]).encode()).hexdigest()[:16]
        folder = f"{self.root}/merchant_dimension"
        if not (found := matching_paths(self.spark, f"{folder}/done/{version}-*")):
            rows = f"{folder}/{version}/{uuid.uuid4().hex}"
            self.merchant_dimension().write.parquet(rows)
            size = measured_bytes(self.spark.read.schema(_DIMENSION).parquet(rows))
            create_file(self.spark, f"{folder}/done/{version}-{size}-{rows.rsplit('/', 1)[1]}")
            found = matching_paths(self.spark, f"{folder}/done/{version}-*")
        # Whoever else resolved it has the same rows.
        _, size, attempt = min(found).rsplit("/", 1)[1].split("-")
        rows = self.spark.read.schema(_DIMENSION).parquet(f"{folder}/{version}/{attempt}")
        return Snapshot(version, rows, int(size))

    def snapshot_for(self, run_seq: int, batch_id: int) -> Snapshot:
        """The newest snapshot, or the one an earlier attempt at this batch took."""
        folder = f"{self.root}/merchant_stats/dimension/{run_seq}-{batch_id}"
        taken = matching_paths(self.spark, f"{folder}/*")
        if taken:
            return self.merchant_snapshot(min(taken).rsplit("/", 1)[1])
        snapshot = self.merchant_snapshot()
        create_file(self.spark, f"{folder}/{snapshot.version}")
        return snapshot

    # --- reading ---
    def graph(self) -> G.Graph:
        def raw(name: str) -> DataFrame:
            return self._current("raw_graph", self.raw, RAW_VIEWS, name)

        return G.Graph(
            customers=lambda: G.seeded_and_stubs(
                G.customer_seed_nodes(self.customer_seed.read()), raw("Customer"), "customer_id"
            ),
            merchants=lambda: G.seeded_and_stubs(
                G.merchant_seed_nodes(self.merchant_seed.read()), raw("Merchant"), "merchant_id"
            ),
            transactions=lambda: raw("Transaction"),
            made=lambda: raw("MADE"),
            at=lambda: raw("AT"),
            category_stats=self.category_stats,
        )

    def category_stats(self, since: datetime | None = None) -> DataFrame:
        """Current statistics, or those of windows from ``since`` on.

        The bound prunes day folders of the base and row groups of the later batches. Totals
        kept per merchant are added up by category; where both logs have a group, these count.
        """
        by_category = self._stats_rows("category_stats", self.stats, STATS_VIEWS["CategoryStats"].resolve, since)
        if not self.merchant_stats.batches() and not self._newest("merchant_stats"):
            return by_category.drop(*ORDER)
        by_merchant = category_stats_by_merchant(
            self._stats_rows("merchant_stats", self.merchant_stats, lambda log: log, since)
        )
        if not self.stats.batches() and not self._newest("category_stats"):
            return by_merchant
        by_category = by_category.select(*by_merchant.columns)
        return by_merchant.unionByName(only_new(by_category, by_merchant, G.STATS_KEY))

    def _stats_rows(
        self, sink: str, log: BatchLog, resolve: Callable[[DataFrame], DataFrame], since: datetime | None
    ) -> DataFrame:
        """Rows of a statistics log: its base and what came later, resolved together."""
        base = self.base(sink, sink)
        since = as_utc(since) if since is not None else None
        in_range = F.lit(True) if since is None else F.col("window_start") >= F.lit(since)
        if base is None:
            return resolve(log.read().where(in_range))
        rows = base.rows
        if since is not None:
            rows = rows.where(F.col("window_date") >= F.lit(since.date()))
        rows = rows.drop("window_date").where(in_range)
        if not self._has_later(log, base):
            return rows
        return resolve(rows.unionByName(log.read(after=base.marks).where(in_range)))

    def merchant_dimension(self) -> DataFrame:
        """Seeded merchants as the enrichment join needs them."""
        return G.merchant_seed_nodes(self.merchant_seed.read()).select("merchant_id", "category")

    def _current(self, sink: str, log: BatchLog, views: dict[str, View], name: str) -> DataFrame:
        view, base = views[name], self.base(sink, name)
        if base is None:
            return view.resolve(log.read()).drop(*ORDER)
        if not self._has_later(log, base):
            # Without a union a bucketed base keeps its partitioning, and joins need no shuffle.
            return base.rows.drop(*ORDER)
        return view.merge(base.rows, view.resolve(log.read(after=base.marks))).drop(*ORDER)

    @staticmethod
    def _has_later(log: BatchLog, base: Base) -> bool:
        return any(batch > base.marks.get(run, -1) for run, batch in log.batches())

    # --- compaction ---
    def _manifest(self, sink: str) -> str:
        return f"{self.root}/{sink}/bases"

    def compactions(self, sink: str) -> list:
        """What each finished compaction put in force, one row per table; nothing else is read."""
        if not path_exists(self.spark, self._manifest(sink)):
            return []
        return self.spark.read.schema(_BASE_SCHEMA).parquet(self._manifest(sink)).collect()

    def _newest(self, sink: str) -> dict:
        """The rows by table of the newest finished compaction."""
        rows = self.compactions(sink)
        newest = max(((row["number"], row["attempt"]) for row in rows), default=None)
        return {row["name"]: row for row in rows if (row["number"], row["attempt"]) == newest}

    def base(self, sink: str, name: str) -> Base | None:
        """A table as the newest finished compaction left it; None before the first one."""
        row = self._newest(sink).get(name)
        if row is None:
            return None
        if row["table_name"] and self.spark.catalog.tableExists(row["table_name"]):
            rows = self.spark.table(row["table_name"])
        elif sink in _STATS_LOGS:
            schema = f"{_STATS_LOGS[sink]}, {RUN} INT, {BATCH} BIGINT, attempt STRING, window_date DATE"
            files = self.spark.read.schema(schema).option("basePath", f"{self.root}/{sink}/base/{sink}")
            rows = files.parquet(*row["parts"]).drop("attempt")
        else:
            rows = self.spark.read.parquet(*row["parts"])
        return Base(rows, tuple(row["parts"]), row["table_name"], dict(row["marks"]))

    def compact_raw(self, upto: Position | None = None, buckets: int | None = None, prefix: str = "graph") -> None:
        """Fold batches up to ``upto`` into bases of one row per key.

        The first write of a key stands for good, so a compaction only adds a part with the
        rows whose keys are new. It writes the base anew when a batch of an older run brought
        an earlier write of a known key, and when the layout is or becomes bucketed.

        Each attempt writes to folders of its own, and readers open what the manifest lists;
        so what a failed attempt left behind is never read.

        With ``buckets`` the bases become catalog tables, bucketed and sorted so that the
        joins along a transaction read them without a shuffle, as long as no later batch has
        to be merged in. Pass the last batch as ``upto`` once the stream has stopped.
        """
        before = self._newest("raw_graph")
        old = dict(next(iter(before.values()))["marks"]) if before else {}
        marks = new_marks(self.raw.batches(), old, upto)
        if marks == old:
            return
        log, attempt, entries = self.raw.read(after=old, upto=marks), uuid.uuid4().hex, []
        for name, view in RAW_VIEWS.items():
            base = self.base("raw_graph", name)
            rows, parts, table = view.resolve(log), [], ""
            location = f"{self.root}/raw_graph/base/{name}/{attempt}"
            if base is not None and (buckets or base.table_name or self._has_earlier(base.rows, rows, view)):
                rows = view.merge(base.rows, rows)
            elif base is not None:
                rows, parts = only_new(rows, base.rows, view.keys, nullable=view.nullable), list(base.parts)
            if buckets:
                key, table = _BUCKET_KEYS[name], f"{prefix}_{name.lower()}_{attempt}"
                (rows.repartition(buckets, key).write.option("path", location)
                    .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
            else:
                rows.sortWithinPartitions(*view.keys).write.parquet(location)
            entries.append((name, table, buckets or 0, [*parts, location]))
        self._record_bases("raw_graph", before, attempt, marks, entries)

    @staticmethod
    def _has_earlier(base: DataFrame, rows: DataFrame, view: View) -> bool:
        """Whether rows hold an earlier write of a key the base knows."""
        if not set(ORDER) <= set(rows.columns):
            return False
        known = base.select(*view.keys, F.struct(*ORDER).alias("_known"))
        joined = rows.select(*view.keys, F.struct(*ORDER).alias("_found")).join(known, list(view.keys))
        return not joined.where(F.col("_found") < F.col("_known")).isEmpty()

    def compact_stats(self, upto: Position | None = None) -> None:
        """Fold batches up to ``upto`` into bases, laid out by the day of the window.

        Totals change until their window closes, so a day that the batches touch is written
        anew; the folders of the other days stay in force.
        """
        view = STATS_VIEWS["CategoryStats"]
        self._compact_days("category_stats", self.stats, lambda log: last_write(log, view.keys, keep_order=True), upto)
        self._compact_days("merchant_stats", self.merchant_stats, category_spans, upto)

    def _compact_days(
        self, sink: str, log: BatchLog, fold: Callable[[DataFrame], DataFrame], upto: Position | None
    ) -> None:
        before = self._newest(sink)
        old = dict(next(iter(before.values()))["marks"]) if before else {}
        marks = new_marks(log.batches(), old, upto)
        if marks == old:
            return
        base, attempt = self.base(sink, sink), uuid.uuid4().hex
        rows = log.read(after=old, upto=marks).withColumn("window_date", F.to_date("window_start"))
        days = [row[0] for row in rows.select("window_date").distinct().collect()]
        kept = [p for p in base.parts if _day_of(p) not in {str(d) for d in days}] if base else []
        if base is not None:
            rows = base.rows.where(F.col("window_date").isin(days)).unionByName(rows)
        location = f"{self.root}/{sink}/base/{sink}/attempt={attempt}"
        # A rebalance splits days with many rows and joins those with few.
        (fold(rows.drop("window_date")).withColumn("window_date", F.to_date("window_start"))
            .hint("rebalance", "window_date").sortWithinPartitions("window_date", "window_start")
            .write.partitionBy("window_date").parquet(location))
        parts = [*kept, *matching_paths(self.spark, f"{location}/window_date=*")]
        self._record_bases(sink, before, attempt, marks, [(sink, "", 0, parts)])

    def expire(self, sink: str) -> None:
        """Delete folded batches, and bases that neither of the two newest compactions lists.

        Call it when no reader still runs on what was current before those.
        """
        log = {"raw_graph": self.raw, "category_stats": self.stats, "merchant_stats": self.merchant_stats}[sink]
        # Of compactions that ran at once and got one number, readers use the last by attempt.
        newest: dict[int, str] = {}
        rows = self.compactions(sink)
        for row in rows:
            newest[row["number"]] = max(row["attempt"], newest.get(row["number"], ""))
        kept = sorted(newest.items())[-2:]
        if not kept:
            return
        rows = [row for row in rows if (row["number"], row["attempt"]) in kept]
        # What the older of the two has not folded yet, its readers still need.
        marks = dict(next(row for row in rows if (row["number"], row["attempt"]) == kept[0])["marks"])
        for run, batch in log.batches():
            if batch <= marks.get(run, -1):
                log.delete(run, batch)
        listed = {_attempt_of(part) for row in rows for part in row["parts"]}
        for folder in matching_paths(self.spark, f"{self.root}/{sink}/base/*/*"):
            if _attempt_of(folder) not in listed:
                delete_folder(self.spark, folder)

    def _record_bases(self, sink: str, before: dict, attempt: str, marks: Marks, entries: list[tuple]) -> None:
        # One file for all tables of a compaction: they come into force together.
        number = max((row["number"] for row in before.values()), default=-1) + 1
        rows = [(number, attempt, name, table, buckets, parts, marks) for name, table, buckets, parts in entries]
        self.spark.createDataFrame(rows, _BASE_SCHEMA).coalesce(1).write.mode("append").parquet(self._manifest(sink))


def _attempt_of(path: str) -> str:
    """Table and attempt of a base folder or of a folder in it, without the way to the store."""
    return "/".join(path.rstrip("/").rsplit("/base/", 1)[1].split("/")[:2])


def _day_of(part: str) -> str:
    return part.rstrip("/").rsplit("window_date=", 1)[1]


def new_marks(batches: list[Position], old: Marks, upto: Position | None) -> Marks:
    """The last batch of each run to fold: up to ``upto``, or all but each run's newest.

    The newest may still be replayed and stays in the log.
    """
    marks = dict(old)
    for run in {run for run, _ in batches}:
        own = [batch for r, batch in batches if r == run]
        own = own[:-1] if upto is None else [batch for batch in own if (run, batch) <= tuple(upto)]
        if own:
            marks[run] = max(own[-1], marks.get(run, -1))
    return marks
