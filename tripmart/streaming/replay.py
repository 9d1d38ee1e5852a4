"""Replaying a day of pickups: extraction, a seeded plan of late sendings, and sending at a pace."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.ranking import numbered

ALLOWED_MINUTES = 30


def events_of_day(trips: DataFrame, day: date) -> DataFrame:
    """The day's pickups as events with stable ids: the day and the place in order of time, zones, licence and miles.

    The partition filter comes first, then a range of times the scan can push down.
    """
    end = day + timedelta(days=1)
    p = F.col("pickup_datetime")
    rows = trips.where((F.col("data_month") == F.lit(day.replace(day=1))) & (p >= F.lit(day).cast("timestamp_ntz")) & (p < F.lit(end).cast("timestamp_ntz")))
    placed = numbered(
        rows.select("hvfhs_license_num", "PULocationID", "DOLocationID", "pickup_datetime", "trip_miles"),
        ["pickup_datetime", "PULocationID", "DOLocationID", "hvfhs_license_num", "trip_miles"], "place"
    )
    return placed.select(
        F.concat(F.lit(f"{day}-"), F.col("place").cast("string")).alias("event_id"), "hvfhs_license_num",
        F.col("PULocationID").alias("pickup_zone_id"), p.cast("timestamp").alias("event_time"), F.lit(day).alias("event_date")
    )


@dataclass(frozen=True)
class Event:
    event_id: str
    hvfhs_license_num: str | None
    pickup_zone_id: int
    event_time: datetime

    def message(self) -> str:
        return json.dumps(
            {
                "event_id": self.event_id, "hvfhs_license_num": self.hvfhs_license_num, "pickup_zone_id": self.pickup_zone_id,
                "event_time": self.event_time.isoformat(timespec="seconds")
            }
        )


@dataclass(frozen=True)
class PlannedEvent:
    event: Event
    send_time: datetime
    delay_minutes: float


def read_events(events: DataFrame, day: date) -> Iterator[Event]:
    """One day's events in order of time, read partition by partition."""
    rows = events.where(F.col("event_date") == F.lit(day)).orderBy("event_time", "event_id")
    for r in rows.select("event_id", "hvfhs_license_num", "pickup_zone_id", "event_time").toLocalIterator():
        yield Event(*r)


def plan(events: Iterable[Event], late_share: float = 0.02, most_minutes: float = 90, seed: int = 7) -> list[PlannedEvent]:
    """Each event with the time it is sent: a share of them late by up to ``most_minutes``.

    The draws are made in the order of the events, one for whether an event is late and one for by how much.
    """
    if not 0 <= late_share <= 1 or most_minutes < 1:
        raise ValueError("the late share is 0 to 1 and the longest delay at least a minute")
    rng, planned = random.Random(seed), []
    for e in events:
        delay = rng.uniform(1, most_minutes) if rng.random() < late_share else 0.0
        planned.append(PlannedEvent(e, e.event_time + timedelta(minutes=delay), delay))
    return sorted(planned, key=lambda p: (p.send_time, p.event.event_id))


def planned_frame(events: DataFrame, late_share: float = 0.02, most_minutes: float = 90, seed: int = 7) -> DataFrame:
    """The same plan for a day of any size: draws come from a hash of the seed and the event, not from a sequence."""
    draw = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("event_id")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    delay = F.when(draw(1) < late_share, 60 * (1 + draw(2) * (most_minutes - 1))).otherwise(F.lit(0.0))
    return events.withColumn("delay_minutes", delay / 60).withColumn(
        "send_time", F.timestamp_micros(F.unix_micros("event_time") + (delay * 1_000_000).cast("bigint"))
    )


def summary(planned: DataFrame) -> DataFrame:
    return planned.agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("delay_minutes") > 0).alias("late"),
        F.count_if(F.col("delay_minutes") > ALLOWED_MINUTES).alias("beyond_allowed")
    )


def replay(
    planned: Iterable[PlannedEvent], send: Callable[[Event], None], speed: float = 600, clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep
) -> int:
    """Send planned events, ``speed`` seconds of theirs in one of ours; waits only for more than a millisecond."""
    if speed <= 0:
        raise ValueError("the speed must be above 0")
    started, first, sent = clock(), None, 0
    for p in planned:
        first = first or p.send_time
        wait = (p.send_time - first).total_seconds() / speed - (clock() - started)
        if wait > 0.001:
            sleep(wait)
        send(p.event)
        sent += 1
    return sent


def paced(
    planned: DataFrame, send: Callable[[DataFrame, int], None], parts: int, speed: float | None = None,
    clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep
) -> int:
    """Send a plan in ``parts`` of equal time, in order, each when its time has come: ``speed`` seconds of the day in one of ours.

    Without a speed the parts follow each other at once. Events of a part are sent side by side by the executors.
    """
    if speed is not None and speed <= 0:
        raise ValueError("the speed must be above 0")
    micros = F.unix_micros("send_time")
    r = planned.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    if r["low"] is None:
        return 0
    started, width, sent = clock(), (r["high"] - r["low"]) // parts + 1, 0
    for n in range(parts):
        wait = n * width / 1e6 / speed - (clock() - started) if speed else 0
        if wait > 0.001:
            sleep(wait)
        part = planned.where((micros >= r["low"] + n * width) & (micros < r["low"] + (n + 1) * width))
        send(part, n)
        sent += 1
    return sent


def drop_files(planned: DataFrame, folder: str, files: int, prefix: str = "") -> None:
    """Send a plan as JSON files, in order of sending; one file is one micro-batch of a file stream.

    The files' names sort by their place; the first ones hold an event more where the number doesn't divide.
    """
    placed = numbered(planned, ["send_time", "event_id"], "place")
    whole, more = divmod(placed.count(), files)
    wide = more * (whole + 1)
    p = F.col("place") - 1
    sent = placed.withColumn("file", F.when(p < wide, F.floor(p / (whole + 1))).otherwise(more + F.floor((p - wide) / max(whole, 1))) + 1)
    path = sent.sparkSession._jvm.org.apache.hadoop.fs.Path
    columns = ["event_id", "hvfhs_license_num", "pickup_zone_id", "event_time"]
    for i in range(1, files + 1):
        part = f"{folder}.{i}"
        sent.where(F.col("file") == i).select(*columns).coalesce(1).write.mode("overwrite").json(part)
        fs = path(part).getFileSystem(sent.sparkSession._jsc.hadoopConfiguration())
        fs.mkdirs(path(folder))
        for s in fs.listStatus(path(part)):
            if s.getPath().getName().endswith(".json"):
                fs.rename(s.getPath(), path(f"{folder}/{prefix}{i:06d}.json"))
        fs.delete(path(part), True)
