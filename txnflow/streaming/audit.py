"""Key constraints checked batch by batch: what new batches touch, against the bases."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.operators import graph as G
from txnflow.operators.quality import shown_key
from txnflow.operators.upsert import ORDER, BatchLog, Marks, keys_of, only_touched
from txnflow.streaming.store import RAW_VIEWS, GraphStore, Position, new_marks

VIOLATION = "check_number BIGINT, label STRING, rule STRING, key STRING, cnt BIGINT"
_CHECK = "number BIGINT, found STRING, marks MAP<STRING, MAP<INT, BIGINT>>"


@dataclass(frozen=True)
class Constraint:
    """A key, the log its rows come from, and the column whose range bounds the scan of the base.

    ``base`` names the compacted table; logs that are never compacted have none.
    """

    label: str
    sink: str
    keys: tuple[str, ...]
    bound: str
    base: str | None = None


CONSTRAINTS = (
    Constraint("Transaction", "raw_graph", G.TRANSACTION_KEY, "transaction_id", "Transaction"),
    Constraint("CategoryStats", "category_stats", G.STATS_KEY, "window_start", "category_stats"),
    Constraint("Customer", "customer_seed", ("customer_id",), "customer_id"),
    Constraint("Merchant", "merchant_seed", ("merchant_id",), "merchant_id"),
)


@dataclass(frozen=True)
class KeyAudit:
    """Checks of a store's keys, each over the batches since the one before it.

    Three rules hold of a sound store. ``batch``: a batch has one row per key, which the
    upserts rely on. ``base``: so has a base. ``maker``: one customer made a transaction.
    A check groups the new batches' rows, and reads of a base only the keys they touch, within
    the range of these keys, which prunes files sorted by them. Where a batch was folded and
    deleted before a check saw it, that check reads the whole base instead.
    """

    store: GraphStore

    @property
    def root(self) -> str:
        return f"{self.store.root}/key_checks"

    def _checks(self) -> list:
        """The finished checks; of those that ran at once and got one number, the last by folder."""
        folder = f"{self.root}/done"
        rows = BatchLog(self.store.spark, folder, _CHECK).read().collect()
        newest = {}
        for row in sorted(rows, key=lambda r: (r["number"], r["found"])):
            newest[row["number"]] = row
        return list(newest.values())

    def _logs(self) -> dict[str, BatchLog]:
        return {
            "raw_graph": self.store.raw, "category_stats": self.store.stats,
            "customer_seed": self.store.customer_seed, "merchant_seed": self.store.merchant_seed,
        }

    def check(self, upto: Position | None = None) -> int:
        """Check what came since the last check and append what breaks a rule; how many keys that are.

        Without ``upto`` each run's newest batch of a sink is left to the next check, as it may still be
        replayed. Seedings are checked as soon as they are finished.
        """
        done = self._checks()
        before = done[-1]["marks"] if done else {}
        number, found_in = (done[-1]["number"] + 1 if done else 0), uuid.uuid4().hex
        found, marks = [], {}
        for sink, log in self._logs().items():
            old = dict(before.get(sink, {}))
            batches = log.batches()
            seeded = sink.endswith("_seed")
            marks[sink] = new_marks(batches, old, max(batches, default=None) if seeded else upto)
            if marks[sink] != old or self._lost(sink, old):
                for constraint in CONSTRAINTS:
                    if constraint.sink == sink:
                        found += self._broken(constraint, log, old, marks[sink])
        if not found:
            return 0
        violations = f"{self.root}/found/{found_in}"
        numbered = reduce(DataFrame.unionByName, found).withColumn("check_number", F.lit(number).cast("long"))
        numbered.write.parquet(violations)
        count = self.store.spark.read.schema(VIOLATION).parquet(violations).count()
        record = self.store.spark.createDataFrame([(number, found_in, marks)], _CHECK).coalesce(1)
        checks = BatchLog(self.store.spark, f"{self.root}/done", _CHECK)
        checks.write(record, 0, checks.claim())
        return count

    def violations(self) -> DataFrame:
        """Every key a finished check found to break a rule, and that check's number."""
        folders = [f"{self.root}/found/{row['found']}" for row in self._checks()]
        if not folders:
            return self.store.spark.createDataFrame([], VIOLATION)
        return self.store.spark.read.schema(VIOLATION).parquet(*folders)

    def _lost(self, sink: str, old: Marks) -> bool:
        """Whether batches after the marks were folded and deleted; a compaction ends on one that was there."""
        there = set(self._logs()[sink].batches())
        return any(
            batch > old.get(run, -1) and (run, batch) not in there
            for row in self.store.compactions(sink) for run, batch in dict(row["marks"]).items()
        )

    def _broken(self, rule: Constraint, log: BatchLog, old: Marks, marks: Marks) -> Iterator[DataFrame]:
        rows = log.read(after=old, upto=marks)
        whole = self._lost(rule.sink, old)
        touched = keys_of(rows, rule.keys)
        yield _repeated(rows, rule.label, "batch", rule.keys, ORDER)
        base = self.store.base(rule.sink, rule.base) if rule.base else None
        if base is not None:
            stored = base.rows if whole else self._near(base.rows, rows, touched, rule)
            yield _repeated(stored, rule.label, "base", rule.keys)
        if rule.sink == "raw_graph":
            # Earlier batches beside the base, so that a maker told before counts as well.
            makers = RAW_VIEWS["MADE"]
            made = log.read(upto=marks).select(*makers.keys)
            base = self.store.base("raw_graph", "MADE")
            if base is not None:
                made = log.read(after=base.marks, upto=marks).select(*makers.keys).unionByName(base.rows.select(*makers.keys))
            made = made if whole else self._near(made, rows, touched, rule)
            made = made.where(F.col("customer_id").isNotNull()).distinct()
            yield _repeated(made, "MADE", "maker", rule.keys)

    @staticmethod
    def _near(stored: DataFrame, rows: DataFrame, touched: DataFrame, rule: Constraint) -> DataFrame:
        """Stored rows of the touched keys; their range reaches the scan as literals."""
        low, high = rows.agg(F.min(rule.bound), F.max(rule.bound)).first()
        if low is None:
            return stored.where(F.lit(False))
        near = stored.where(F.col(rule.bound).between(F.lit(low), F.lit(high)))
        if "window_date" in stored.columns:
            near = near.where(F.col("window_date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
        return only_touched(near, touched, rule.keys)


def _repeated(
    rows: DataFrame, label: str, rule: str, keys: tuple[str, ...], within: tuple[str, ...] = ()
) -> DataFrame:
    counted = rows.groupBy(*keys, *within).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
    named: list[Column] = [F.lit(label).alias("label"), F.lit(rule).alias("rule"), shown_key(keys).alias("key")]
    return counted.select(*named, "cnt")

