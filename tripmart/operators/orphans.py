"""References to records that do not exist: pending orphans kept by key, advanced increment by increment.

The state is a bundle of parts: ``parents``, the index of spans in which a parent row with a key is in force;
``pending``, one row per orphan key with the references that met no parent and whether they wait now; ``found``,
the log of orphans per key and period; ``snapshots``, what was counted at the end of each increment. ``advance`` takes in
a period's references and the parents that arrived and were deleted in it, all at once under the increment's number:

* new references probe the index for a parent in force on any day of their own period; those that meet none are
  orphans, logged and pending;
* a parent that arrives later resolves the orphans waiting for its key, a deletion reopens them;
* the snapshot counts the references, the orphans among them, and all that wait on the period's last day.

References travel as counts per key and period, combined before the shuffle, so no key is hot; the rows behind the
orphans are read once more at the end. A null key refers to nothing and is left out. A reference with a null period is
judged only for ``timeless`` columns, whose parents have no lives (a calendar). A parent without a start was always
there, one without an end still is; a span that ends before it begins is empty; of spans that begin together the longest
holds. Repeated references count as often as they occur. With no parents at all every reference is an orphan; with
no references there is no orphan. An increment that fails leaves the state as it was, one that comes again is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import checkpoint
from tripmart.store import Bundle

EVER, NEVER = "0001-01-01", "9999-12-31"
REFERENCE, SPAN = "ref_column string, key bigint, period date, n bigint", "ref_column string, key bigint, begins date, ends date"
PENDING = "ref_column string, key bigint, n bigint, waiting boolean"
KEY = ["ref_column", "key"]


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def references(facts: DataFrame, columns: Sequence[str], month: str) -> DataFrame:
    """Counts of references per (ref_column, key, period): one scan for all columns, combined before the shuffle."""
    entries = F.array(*[F.struct(F.lit(c).alias("ref_column"), F.col(c).cast("bigint").alias("key")) for c in columns])
    rows = facts.select(F.trunc(F.col(month), "month").alias("period"), F.inline(entries)).where(F.col("key").isNotNull())
    return rows.groupBy(*KEY, "period").agg(F.count(F.lit(1)).alias("n"))


def parents(table: DataFrame, ref_column: str, key: str, begins: str | None = None, ends: str | None = None) -> DataFrame:
    """Spans in which rows of a dimension are in force; ``ends`` is the first day they no longer are."""
    start = F.coalesce(F.col(begins), _day(EVER)) if begins else _day(EVER)
    end = F.coalesce(F.col(ends), _day(NEVER)) if ends else _day(NEVER)
    rows = table.select(F.lit(ref_column).alias("ref_column"), F.col(key).cast("bigint").alias("key"), start.alias("begins"), end.alias("ends"))
    return rows.where(F.col("key").isNotNull() & (F.col("ends") > F.col("begins"))).groupBy(*KEY, "begins").agg(F.max("ends").alias("ends"))


@dataclass(frozen=True)
class OrphanState:
    spark: SparkSession
    root: str
    timeless: tuple[str, ...] = ()

    @property
    def bundle(self) -> Bundle:
        return Bundle(self.spark, self.root)

    def read(self, part: str) -> DataFrame:
        found = self.bundle.read(part)
        if found is None:
            raise LookupError(f"no increment has been taken in at {self.root}")
        return found

    def advance(self, step: int, period: date | None, new_references: DataFrame, arrived: DataFrame | None = None, deleted: DataFrame | None = None) -> None:
        """Take in the references of ``period`` and the spans that ``arrived`` or, with their end, were ``deleted`` in it."""
        state = self.bundle
        if step <= state.step():
            return
        index, replaced = state.read("parents"), {}
        changes = [c for c in (None if arrived is None else arrived.withColumn("ends", _day(NEVER)), deleted) if c is not None]
        if changes or index is None:
            parts = [*([] if index is None else [index]), *(changes or [self.spark.createDataFrame([], SPAN)])]
            # a span is given again when it ends
            replaced["parents"] = state.stage(reduce(DataFrame.unionByName, parts).groupBy(*KEY, "begins").agg(F.min("ends").alias("ends")))
            index = replaced["parents"].rows
        # each frame is written before the next is made of it: none is made twice
        found = state.stage(self._unmet(new_references, index))
        orphans = found.rows
        pending = state.read("pending")
        more = orphans.select(*KEY, "n")
        pending = (more if pending is None else pending.select(*KEY, "n").unionByName(more)).groupBy(*KEY).agg(F.sum("n").alias("n"))
        last = F.last_day(F.lit(period)) if period else _day(NEVER)
        there = index.where((F.col("begins") <= last) & (F.col("ends") > last)).select(*KEY, F.lit(True).alias("there")).distinct()
        waits = state.stage(pending.join(there, KEY, "left").select(*KEY, "n", F.isnull("there").alias("waiting")))
        state.commit(
            step, replace={**replaced, "pending": waits},
            append={"found": found, "snapshots": self._snapshot(period, new_references, orphans, waits.rows)}
        )

    def _unmet(self, rows: DataFrame, index: DataFrame) -> DataFrame:
        """The references for which no parent is in force on any day of their period."""
        judged = rows.where(F.col("period").isNotNull() | F.col("ref_column").isin(list(self.timeless)))
        spans = index.select(*[F.col(c).alias(f"__{c}") for c in index.columns])
        always = (F.col("__begins") == _day(EVER)) & (F.col("__ends") == _day(NEVER))
        within = (F.col("__begins") <= F.last_day("period")) & (F.col("__ends") > F.col("period"))
        same = (F.col("ref_column") == F.col("__ref_column")) & (F.col("key") == F.col("__key"))
        return judged.join(spans, same & (always | F.coalesce(within, F.lit(False))), "left_anti")

    @staticmethod
    def _snapshot(period: date | None, new_references: DataFrame, orphans: DataFrame, pending: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        entry = lambda df, **figures: df.select(
            "ref_column", *[figures.get(c, zero).alias(c) for c in ("references", "orphans", "orphan_keys", "waiting", "here")]
        )
        one = F.lit(1).cast("bigint")
        rows = entry(new_references, references=F.col("n"), here=one).unionByName(entry(orphans, orphans=F.col("n"), orphan_keys=one))
        if period:  # references without a period wait for no day
            rows = rows.unionByName(entry(pending.where("waiting"), waiting=F.col("n")))
        counted = rows.groupBy("ref_column").agg(*[F.sum(c).alias(c) for c in ("references", "orphans", "orphan_keys", "waiting", "here")]).where("here > 0")
        return counted.select("ref_column", F.lit(period).cast("date").alias("period"), "references", "orphans", "orphan_keys", "waiting")

    def replay(self, all_references: DataFrame, spans: DataFrame) -> None:
        """Advance period by period through a history: each increment has its references and the spans that begin or end in it.

        The references without a period come last. There are as many increments as months, whatever their size.
        """
        counted, spans = checkpoint(all_references), checkpoint(spans)
        periods = [r["period"] for r in counted.where("period IS NOT NULL").select("period").distinct().orderBy("period").collect()]
        # the months in which any span begins or ends: as many rows as months
        moves = spans.select(F.explode(F.array("begins", "ends")).alias("day")).select(F.trunc("day", "month").alias("month")).distinct()
        moved = sorted(r["month"] for r in moves.collect())
        before = None
        for step, period in enumerate(periods):
            last, arrived, deleted = F.last_day(F.lit(period)), None, None
            if any((before is None or m > before) and m <= period for m in moved):
                since = F.lit(True) if before is None else F.col("begins") > F.last_day(F.lit(before))
                ended = F.lit(True) if before is None else F.col("ends") > F.last_day(F.lit(before))
                arrived = spans.where(since & (F.col("begins") <= last))
                deleted = spans.where(ended & (F.col("ends") <= last) & (F.col("ends") != _day(NEVER)))
            self.advance(step, period, counted.where(F.col("period") == F.lit(period)), arrived, deleted)
            before = period
        without = counted.where("period IS NULL")
        if not periods or not without.isEmpty():
            self.advance(len(periods), None, without, None if periods else spans)


def orphan_rows(facts: DataFrame, found: DataFrame, columns: Sequence[str], month: str, *, broadcast_keys: int = 200_000) -> DataFrame:
    """The fact rows behind the orphans found, one per orphan reference: ``facts`` columns with ``ref_column``.

    The orphan keys are broadcast while there are at most ``broadcast_keys`` of them; beyond that the join
    shuffles, and adaptive execution splits the partitions of hot keys.
    """
    keys = found.select(F.col("ref_column").alias("__c"), F.col("key").alias("__k"), F.col("period").alias("__p"))
    if keys.count() <= broadcast_keys:
        keys = F.broadcast(keys)
    kept = [c for c in facts.columns if c != "ref_column"]
    entries = F.array(*[F.struct(F.lit(c).alias("ref_column"), F.col(c).cast("bigint").alias("__key")) for c in columns])
    rows = facts.select(*[F.col(f"`{c}`") for c in kept], F.trunc(F.col(month), "month").alias("__period"), F.inline(entries))
    same = (rows["ref_column"] == keys["__c"]) & (rows["__key"] == keys["__k"]) & rows["__period"].eqNullSafe(keys["__p"])
    return rows.join(keys, same, "left_semi").drop("__period", "__key")
