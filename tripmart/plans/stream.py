"""The queries of replay, stream and reconciliation; streams run to the end of what is there."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans import batch_sql
from tripmart.plans.batch import accepted
from tripmart.session import checkpoint, checkpoint_dir
from tripmart.sources.tables import read
from tripmart.store import Table
from tripmart.streaming import pickups, reconcile, replay

DAY = date(2025, 1, 15)
FILES = 12


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"


def replay_events(spark: SparkSession, d: str) -> DataFrame:
    return replay.events_of_day(accepted(spark, d), DAY)


def replay_plan_summary(spark: SparkSession, d: str) -> DataFrame:
    return replay.summary(replay.planned_frame(replay_events(spark, d)))


def _sendings(spark: SparkSession, d: str) -> DataFrame:
    return pickups.valid(
        read(spark, d, "pickup_events").where("send_time IS NOT NULL").select("event_id", "hvfhs_license_num", "pickup_zone_id", "event_time", "send_time")
    )


def _streamed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The sendings of all days and the windows the stream made of them, sent in files of equal size."""
    base, sent = _folder(spark), checkpoint(_sendings(spark, d))
    replay.drop_files(sent, f"{base}/in", FILES)
    table = Table(spark, f"{base}/table")
    pickups.run_until_caught_up(spark, f"{base}/in", table, f"{base}/checkpoint")
    return sent, table.read()


def stream_windows_late(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d)[1]


def stream_windows_on_time(spark: SparkSession, d: str) -> DataFrame:
    """The stream over TPC-H-like events, which come in order: nothing is late."""
    base = _folder(spark)
    ordered = read(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.lit(None).cast("string").alias("hvfhs_license_num"),
        (F.col("user_id") + 1).cast("int").alias("pickup_zone_id"), F.col("ts").cast("timestamp").alias("event_time")
    )
    replay.drop_files(pickups.valid(ordered).withColumn("send_time", F.col("event_time")), f"{base}/in", 4)
    table = Table(spark, f"{base}/table")
    pickups.run_until_caught_up(spark, f"{base}/in", table, f"{base}/checkpoint")
    return table.read()


def reconcile_cells(spark: SparkSession, d: str) -> DataFrame:
    sent, windows = _streamed(spark, d)
    return reconcile.cells(reconcile.hourly_from_events(sent), reconcile.hourly_from_windows(windows))


def stream_run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Windows and trips of the stream's table, and the trips of all sendings."""
    sent, windows = _streamed(spark, d)
    r = pickups.summary(windows, {"sent": sent.count()})
    return spark.createDataFrame([(r["windows"], r["trips"], r["sent"])], "windows bigint, trips bigint, sent bigint")


def parse_events_json(spark: SparkSession, d: str) -> DataFrame:
    """All sendings as JSON messages, and as many broken ones between them; those that can be read."""
    message = F.to_json(F.struct("event_id", "hvfhs_license_num", "pickup_zone_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time")))
    raw = read(spark, d, "pickup_events").select(F.explode(F.array(message, F.substring(message, 1, 20))).alias("value"))
    return pickups.parse(raw)


def stream_run_log(spark: SparkSession, d: str) -> DataFrame:
    """Three runs recorded, one of them twice."""
    runs = Table(spark, f"{_folder(spark)}/runs")
    at = datetime(2025, 1, 15, tzinfo=timezone.utc)
    for run, n in (("a", 1), ("b", 2), ("a", 3), ("c", 4)):
        pickups.record_run(runs, run, DAY, at, at, {"batches": n, "input_rows": n * 10, "dropped_late_rows": 0})
    return runs.read()


QUERIES = {
    "replay_events": replay_events, "replay_plan_summary": replay_plan_summary, "stream_windows_on_time": stream_windows_on_time, "stream_windows_late": stream_windows_late,
    "reconcile_cells": reconcile_cells, "stream_run_summary": stream_run_summary, "parse_events_json": parse_events_json, "stream_run_log": stream_run_log,
}

_SENT = f"""s AS (SELECT event_id, pickup_zone_id, event_time, send_time FROM pickup_events WHERE send_time IS NOT NULL AND event_time IS NOT NULL AND pickup_zone_id IS NOT NULL),
    k AS (SELECT *, ntile({FILES}) OVER (ORDER BY send_time, event_id) AS k FROM s),
    tops AS (SELECT k, max(event_time) AS top FROM k GROUP BY 1),
    marks AS (SELECT k, max(top) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS mark FROM tops),
    j AS (SELECT k.*, time_bucket(INTERVAL '15 minutes', event_time) AS ws, mark FROM k JOIN marks ON k.k = marks.k),
    kept AS (SELECT * FROM j WHERE mark IS NULL OR ws + INTERVAL '15 minutes' > mark - INTERVAL '30 minutes')"""
SQL = {
    "replay_events": batch_sql.replay_events(DAY),
    "stream_windows_late": f"WITH {_SENT} SELECT ws AS window_start, ws + INTERVAL '15 minutes' AS window_end, pickup_zone_id, count(*) AS trips FROM kept GROUP BY ALL",
    "stream_windows_on_time": "SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end, CAST(user_id + 1 AS INTEGER) AS pickup_zone_id, count(*) AS trips FROM events GROUP BY ALL",
    "reconcile_cells": f"""WITH {_SENT}, b AS (SELECT CAST(hour(event_time) AS INTEGER) AS hour, pickup_zone_id AS zone, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT CAST(hour(event_time) AS INTEGER) AS hour, pickup_zone_id AS zone, count(*) AS n FROM kept GROUP BY ALL)
      SELECT b.hour, b.zone, b.n AS batch_trips, coalesce(t.n, 0) AS stream_trips, CASE WHEN b.n = coalesce(t.n, 0) THEN 'equal' WHEN coalesce(t.n, 0) < b.n THEN 'short' ELSE 'over' END AS verdict FROM b LEFT JOIN t ON b.hour = t.hour AND b.zone = t.zone""",
    "stream_run_summary": f"WITH {_SENT} SELECT (SELECT count(*) FROM (SELECT DISTINCT ws, pickup_zone_id FROM kept)) AS windows, (SELECT count(*) FROM kept) AS trips, (SELECT count(*) FROM s) AS sent",
    "parse_events_json": "SELECT event_id, hvfhs_license_num, pickup_zone_id, date_trunc('second', event_time) AS event_time FROM pickup_events WHERE event_time IS NOT NULL AND pickup_zone_id IS NOT NULL",
    "stream_run_log": "SELECT * FROM (VALUES ('a', 3, 30::BIGINT), ('b', 2, 20::BIGINT), ('c', 4, 40::BIGINT)) v(run_id, batches, input_rows) CROSS JOIN (SELECT DATE '2025-01-15' AS replay_day, TIMESTAMPTZ '2025-01-15 00:00:00+00' AS started_at, TIMESTAMPTZ '2025-01-15 00:00:00+00' AS finished_at, 0::BIGINT AS dropped_late_rows)",
}
