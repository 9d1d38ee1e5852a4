"""Late and out-of-order events: K-slack reordering over the order of sending.

Events are taken in the order they were sent. Behind the greatest event time sent so far minus the slack lies
what is final: an event whose window ended at or before that line when it was sent is late and goes to a
report of its own; every other event waits in the buffer until the line passes its window and is then released,
in order of event time, to the final aggregation. Until then each window's value so far is published as
provisional and corrected by the events that follow.

The greatest event time sent before an event is a running maximum over a whole day, which no task may hold.
So the days are cut into ranges of sending time of equal size (a range shuffle), each range's maximum is
taken, and the running maximum inside a range starts from that of the ranges before it, one row each.

Rows without event id or sending time can't be ordered and are left out; of an event's sendings on a day only
the first counts, the first by all columns where two were sent at once; events whose first sending lacks the event time or
a grouping column are left out; events sent at the same moment don't precede each other. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import checkpoint, shuffle_partitions


def first_sendings(events: DataFrame, day: str, event: str, sent: str) -> DataFrame:
    """The first sending of each event of a day; combined before the shuffle, so repeats of one event don't pile up."""
    rest = [c for c in events.columns if c not in (day, event, sent)]
    whole = F.struct(F.col(sent), *[F.col(c) for c in rest])
    kept = events.where(F.col(event).isNotNull() & F.col(sent).isNotNull()).groupBy(day, event).agg(F.min(whole).alias("__first"))
    return kept.select(day, event, *[F.col(f"__first.{c}").alias(c) for c in [sent, *rest]])


def ranged(events: DataFrame, day: str, sent: str) -> DataFrame:
    """The events cut into ranges of sending time of about equal size, ``__range``, written once."""
    spark = events.sparkSession
    ranges = max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism)
    # written, so that all uses see the same ranges even when executors are lost
    return checkpoint(events.withColumn("__sent", F.unix_micros(sent)).repartitionByRange(ranges, day, "__sent").withColumn("__range", F.spark_partition_id()))


def judged(cut: DataFrame, day: str, time: str, needed: Sequence[str], window_minutes: int, slack_minutes: int, tops: DataFrame | None = None) -> DataFrame:
    """Events of ``ranged`` with ``window_start``, ``seen`` (the greatest event time sent before) and ``late``.

    ``tops`` holds the greatest event time of each day in what was sent before these events, where there was any.
    """
    kept = cut
    for c in [time, *needed]:
        kept = kept.where(F.col(c).isNotNull())
    width, slack = window_minutes * 60_000_000, slack_minutes * 60_000_000
    kept = kept.withColumn("__time", F.unix_micros(time))
    # a row for each range of a day
    maxima = kept.groupBy(day, "__range").agg(F.max("__time").alias("__time"))
    if tops is not None:
        maxima = maxima.unionByName(tops.select(day, F.lit(-1).alias("__range"), F.unix_micros(time).alias("__time")).where(F.col("__time").isNotNull()))
    carried = maxima.select(
        day, "__range",
        F.max("__time").over(Window.partitionBy(day).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)).alias("__time")
    ).where(F.col("__time").isNotNull() & (F.col("__range") >= 0))
    # the maximum carried into a range stands before its first event
    both = kept.unionByName(carried.withColumn("__sent", F.lit(-(2**62))), allowMissingColumns=True)
    before = Window.partitionBy(day, "__range").orderBy("__sent").rangeBetween(Window.unboundedPreceding, -1)
    seen = both.withColumn("__seen", F.max("__time").over(before)).where(F.col("__sent") != F.lit(-(2**62)))
    start = F.col("__time") - F.pmod(F.col("__time"), F.lit(width))
    late = F.coalesce(start + width <= F.col("__seen") - slack, F.lit(False))
    out = seen.withColumns({"window_start": F.timestamp_micros(start), "seen": F.timestamp_micros("__seen"), "late": late})
    return out.drop("__time", "__sent", "__range", "__seen")


def final_windows(events: DataFrame, groups: Sequence[str], event: str, time: str = "event_time", *, piece_seconds: int = 60) -> DataFrame:
    """Final values per group and window: trips, order-sensitive figures of the reordered events, late events left out.

    A window is put in order piece by piece, ``piece_seconds`` of event time each, and the pieces, one row each, are
    joined in their order: no task sorts a whole window of a hot group.
    """
    by = [*groups, "window_start"]
    micros = F.unix_micros(time)
    cut = events.where(~F.col("late")).withColumn("__piece", F.floor(micros / (piece_seconds * 1_000_000)))
    order = Window.partitionBy(*by, "__piece").orderBy(time, event)
    place = F.struct(time, event)
    pieces = cut.withColumn("__gap", micros - F.lag(micros).over(order)).groupBy(*by, "__piece").agg(
        F.count(F.lit(1)).alias("n"), F.max("__gap").alias("gap"), F.min(place).alias("first"), F.max(place).alias("last"))
    across = F.unix_micros(F.col("first")[time]) - F.unix_micros(F.lag("last").over(Window.partitionBy(*by).orderBy("__piece"))[time])
    return pieces.withColumn("gap", F.greatest("gap", across)).groupBy(*by).agg(
        F.sum("n").alias("trips"), F.floor(F.max("gap") / 1_000_000).alias("longest_gap_seconds"), F.min("first")[event].alias("first_event"), F.max("last")[event].alias("last_event"),
    )


def with_late(final: DataFrame, late: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Final windows with ``late_trips``; a window that only late events fell into has no trips."""
    by = [*groups, "window_start"]
    counted = late.groupBy(*by).agg(F.count(F.lit(1)).alias("late_trips"))
    both = final.unionByName(counted, allowMissingColumns=True).groupBy(*by)
    zero = F.lit(0).cast("bigint")
    return both.agg(
        F.coalesce(F.sum("trips"), zero).alias("trips"), F.max("longest_gap_seconds").alias("longest_gap_seconds"),
        F.max("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
        F.coalesce(F.sum("late_trips"), zero).alias("late_trips")
    )


def revisions(events: DataFrame, groups: Sequence[str], *, every_minutes: int, sent: str = "send_time") -> DataFrame:
    """What is published of each window: after every ``every_minutes`` in which it changed, its value so far.

    ``revision`` counts a window's publications.
    """
    by = [*groups, "window_start"]
    step = every_minutes * 60_000_000
    at = F.unix_micros(sent) - F.pmod(F.unix_micros(sent), F.lit(step)) + step
    ticks = events.where(~F.col("late")).groupBy(*by, F.timestamp_micros(at).alias("published_at")).agg(F.count(F.lit(1)).alias("new_trips"))
    order = Window.partitionBy(*by).orderBy("published_at")
    return ticks.select(*by, "published_at", "new_trips", F.sum("new_trips").over(order).alias("trips_so_far"), F.row_number().over(order).alias("revision"))


def with_final(published: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Publications with ``is_final``: the last one of a window, which holds its released value."""
    order = Window.partitionBy(*groups, "window_start").orderBy("published_at")
    return published.withColumn("is_final", F.lead("published_at").over(order).isNull())
