"""K-slack in increments: micro-batches of sendings in, provisional and final windows and late events out.

Between batches the state lies in one bundle: the greatest event time of each day, the ids seen, and the buffer of
events whose windows are still open. A batch is judged as the whole day would be (``operators.kslack``); windows that
the line has passed are released from the buffer, in order of event time, and are final; of the others the value so far
is published. Batches cut anywhere in the order of sending give the final windows and late events of one pass over
all sendings; the log of publications is that of one pass where batches are cut between ticks of ``every_minutes``.

All of a batch is committed at once under its number. A batch that fails leaves the state as it was and may run
again; one that is committed is skipped when it comes again, so a query restarted from its checkpoint counts nothing
twice. Final windows, late events, ids and publications are appended, buffer and provisional values are replaced:
the work of a batch follows its size, that of the open windows and the ids of the open days, which ``close`` forgets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import kslack
from tripmart.session import checkpoint
from tripmart.store import Bundle

DAY, EVENT, ZONE, TIME, SENT = "event_date", "event_id", "pickup_zone_id", "event_time", "send_time"
GROUPS = [DAY, ZONE]


@dataclass(frozen=True)
class SlackStream:
    root: str
    window_minutes: int = 15
    slack_minutes: int = 30
    every_minutes: int = 15

    def bundle(self, spark: SparkSession) -> Bundle:
        return Bundle(spark, self.root)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """``final``, ``late``, ``provisional``, ``published`` (or ``buffer``, ``ids``, ``tops``) after the last batch."""
        found = self.bundle(spark).read(name)
        if found is None:
            raise LookupError(f"no batch has been taken in at {self.root}")
        return found

    def add(self, batch: DataFrame, number: int) -> None:
        """Take in a micro-batch, all of whose rows were sent after those of the batches before."""
        spark = batch.sparkSession
        state = self.bundle(spark)
        if number <= state.step():
            return
        rows = kslack.first_sendings(batch.select(DAY, EVENT, ZONE, TIME, SENT), DAY, EVENT, SENT)
        ids, tops, buffer = state.read("ids"), state.read("tops"), state.read("buffer")
        cut = kslack.ranged(rows if ids is None else rows.join(ids, [DAY, EVENT], "left_anti"), DAY, SENT)
        now = kslack.judged(cut, DAY, TIME, [ZONE], self.window_minutes, self.slack_minutes, tops)
        whole = cut.where(F.col(ZONE).isNotNull()).groupBy(DAY).agg(F.max(TIME).alias(TIME))
        tops = checkpoint(whole if tops is None else whole.unionByName(tops).groupBy(DAY).agg(F.max(TIME).alias(TIME)))  # a row a day
        both = (
            now if buffer is None else now.unionByName(buffer.withColumn("__old", F.lit(True)), allowMissingColumns=True)
        ).withColumn("__new", F.isnull("__old") if buffer is not None else F.lit(True))
        end = F.col("window_start") + F.expr(f"INTERVAL {self.window_minutes} MINUTES")
        passed = end <= F.col("__line") - F.expr(f"INTERVAL {self.slack_minutes} MINUTES")
        lines = tops.select(DAY, F.col(TIME).alias("__line"))
        held = checkpoint(both.drop("__old").join(lines, DAY, "left").withColumn("__passed", F.coalesce(passed, F.lit(False))).drop("__line"))
        waiting = held.where("NOT late")
        kept = waiting.where("NOT __passed").drop("__passed", "__new")
        # what was published of a window before is in the buffer too, so its later publications go on from there
        changed = waiting.where("__new").select(*GROUPS, "window_start", SENT)
        published = kslack.revisions(waiting, GROUPS, every_minutes=self.every_minutes).join(
            self._ticks(changed), [*GROUPS, "window_start", "published_at"], "left_semi"
        )
        state.commit(
            number,
            replace={"buffer": kept, "provisional": self._windows(kept), "tops": tops},
            append={
                "final": self._windows(waiting.where("__passed")), "late": held.where("late").select(DAY, EVENT, ZONE, TIME, SENT, "window_start", "seen"),
                "ids": cut.select(DAY, EVENT), "published": published,
            },
        )

    def _ticks(self, changed: DataFrame) -> DataFrame:
        return kslack.revisions(
            changed.withColumn("late", F.lit(False)), GROUPS, every_minutes=self.every_minutes
        ).select(*GROUPS, "window_start", "published_at")

    @staticmethod
    def _windows(events: DataFrame) -> DataFrame:
        return kslack.final_windows(events, GROUPS, EVENT)

    def close(self, spark: SparkSession, days: Sequence | None = None) -> None:
        """End days, all where none are named: what their buffer holds is final, their ids and lines are forgotten."""
        state = self.bundle(spark)
        buffer = self.read(spark, "buffer")
        over = F.lit(True) if days is None else F.col(DAY).isin(list(days))
        kept = buffer.where(~over)
        state.commit(
            state.step(),
            replace={"buffer": kept, "provisional": self._windows(kept), **{n: self.read(spark, n).where(~over) for n in ("ids", "tops")}},
            append={"final": self._windows(buffer.where(over))},
        )
        state.vacuum()

    def run(self, sendings: DataFrame, checkpoint_folder: str):
        """Run over a stream of sendings, batch by batch, to the end of what is there."""
        writer = sendings.writeStream.foreachBatch(lambda df, n: self.add(df, n)).option("checkpointLocation", checkpoint_folder)
        return writer.trigger(availableNow=True).start()

    def take(self, events: DataFrame, *, least_batches: int = 3, batch_rows: int = 20_000_000) -> None:
        """Take in a stored table in the order of sending: batches of about ``batch_rows`` rows, at least ``least_batches``, cut between ticks."""
        sent = F.unix_micros(SENT)
        n = max(least_batches, -(-events.agg(F.count(SENT)).first()[0] // batch_rows))
        points = events.agg(F.percentile_approx(sent, [k / n for k in range(1, n)]).alias("p")).first()["p"] or []
        tick = self.every_minutes * 60_000_000
        cuts = [None, *sorted({int(p) // tick * tick for p in points}), None]
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            batch = events.where(F.col(SENT).isNotNull())
            for bound, inside in ((low, lambda c, b: c >= b), (high, lambda c, b: c < b)):
                batch = batch if bound is None else batch.where(inside(F.col(SENT), F.timestamp_micros(F.lit(bound))))
            self.add(batch, k)
