"""Holding the stream's hours and zones against the batch's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_from_events(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("event_time").alias("hour"), F.col("pickup_zone_id").alias("zone")).agg(F.count(F.lit(1)).alias("trips"))


def hourly_from_windows(windows: DataFrame) -> DataFrame:
    return windows.groupBy(F.hour("window_start").alias("hour"), F.col("pickup_zone_id").alias("zone")).agg(F.sum("trips").alias("trips"))


def cells(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """``hour, zone, batch_trips, stream_trips, verdict``: every cell of either side."""
    b, s = batch.withColumnRenamed("trips", "batch_trips"), stream.withColumnRenamed("trips", "stream_trips")
    zero = F.lit(0).cast("bigint")
    both = b.join(s, ["hour", "zone"], "full").withColumns({"batch_trips": F.coalesce("batch_trips", zero), "stream_trips": F.coalesce("stream_trips", zero)})
    return both.withColumn(
        "verdict",
        F.when(F.col("batch_trips") == F.col("stream_trips"), "equal").when(F.col("stream_trips") < F.col("batch_trips"), "short").otherwise("over")
    )


@dataclass(frozen=True)
class Verdict:
    batch_trips: int
    stream_trips: int
    equal: int
    short: int
    over: int
    missing: int
    dropped: int

    @property
    def reconciled(self) -> bool:
        """The stream lacks exactly the late events it dropped, and has nothing the batch lacks."""
        return self.missing == self.dropped and self.over == 0


def compare(batch: DataFrame, stream: DataFrame, dropped: int) -> Verdict:
    """``dropped``: late events, counted one by one (the engine's own figure counts them after partial aggregation)."""
    count = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    missing = F.coalesce(F.sum(F.greatest(F.col("batch_trips") - F.col("stream_trips"), F.lit(0))), F.lit(0)).alias("missing")
    r = cells(batch, stream).agg(
        F.coalesce(F.sum("batch_trips"), F.lit(0)).alias("b"), F.coalesce(F.sum("stream_trips"), F.lit(0)).alias("s"), count("equal"),
        count("short"), count("over"), missing
    ).first()
    return Verdict(r["b"], r["s"], r["equal"], r["short"], r["over"], r["missing"], dropped)


def report(day: str, v: Verdict) -> str:
    rows = [
        ("trips of the batch", v.batch_trips), ("trips of the stream", v.stream_trips), ("equal cells", v.equal), ("short cells", v.short),
        ("cells over", v.over), ("missing trips", v.missing), ("late events dropped", v.dropped)
    ]
    lines = [
        f"# Stream and batch of {day}", "", "| figure | value |", "|-|-|", *[f"| {n} | {x:,} |" for n, x in rows], "",
        "RECONCILED" if v.reconciled else "NOT RECONCILED"
    ]
    return "\n".join(lines) + "\n"
