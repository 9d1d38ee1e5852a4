"""Pickups per zone and 15 minutes as a stream: sources, the windowed count, its table and the log of runs."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.layers import bounded_broadcast
from tripmart.store import Table

EVENT = "event_id string, hvfhs_license_num string, pickup_zone_id int, event_time timestamp"
WINDOW, ALLOWED = "15 minutes", "30 minutes"
RUN = "run_id string, replay_day date, started_at timestamp, finished_at timestamp, batches int, input_rows bigint, dropped_late_rows bigint"


def parse(raw: DataFrame) -> DataFrame:
    """Events from JSON messages in ``value``; malformed ones and those without time or zone are left out."""
    fields = F.from_json(F.col("value").cast("string"), EVENT)
    return valid(raw.select(fields.alias("e")).select("e.*"))


def valid(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_time").isNotNull() & F.col("pickup_zone_id").isNotNull())


def file_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """JSON files as they arrive, in order of their names at equal times."""
    return valid(spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).option("latestFirst", "false").json(folder))


def kafka_events(spark: SparkSession, servers: str, topic: str, most_offsets: int = 50_000) -> DataFrame:
    """A topic from its beginning, at a limited rate; needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(most_offsets)}
    return parse(spark.readStream.format("kafka").options(**options).load())


def windows(events: DataFrame, allowed: str = ALLOWED) -> DataFrame:
    w = F.window("event_time", WINDOW)
    counted = events.withWatermark("event_time", allowed).groupBy(w, "pickup_zone_id").agg(F.count(F.lit(1)).alias("trips"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "pickup_zone_id", "trips")


def run(events: DataFrame, table: Table, checkpoint: str, *, until_caught_up: bool = True):
    """Start the stream: every micro-batch's changed windows are merged into the table."""

    def merge(batch: DataFrame, _: int) -> None:
        stored = batch.persist()  # read twice; reading the source twice would count dropped rows twice
        try:
            table.upsert(stored, ["window_start", "pickup_zone_id"])
        finally:
            stored.unpersist()

    writer = windows(events).writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer.trigger(processingTime="5 seconds")).start()


def progress(query) -> dict[str, int]:
    """Batches, rows read, and rows the watermark dropped after partial aggregation, as the engine counts them."""
    reports = query.recentProgress
    dropped = sum(int(o.get("numRowsDroppedByWatermark", 0)) for p in reports for o in p["stateOperators"])
    return {"batches": len(reports), "input_rows": sum(int(p["numInputRows"]) for p in reports), "dropped_late_rows": dropped}


def record_run(runs: Table, run_id: str, replay_day, started_at: datetime, finished_at: datetime, figures: dict[str, int]) -> None:
    """One row per run; the same run again replaces its row."""
    row = (run_id, replay_day, started_at, finished_at, figures["batches"], figures["input_rows"], figures["dropped_late_rows"])
    runs.upsert(runs.spark.createDataFrame([row], RUN), ["run_id"])


def run_until_caught_up(
    spark: SparkSession, source: str | DataFrame, table: Table, checkpoint: str, runs: Table | None = None, replay_day=None, *,
    files_per_trigger: int = 1, seconds: float | None = None
) -> dict[str, int]:
    """Run over a folder of files or a stream of events to the end of what is there or, with ``seconds``, on and on for so long."""
    started = datetime.now(timezone.utc)
    query = run(file_events(spark, source, files_per_trigger) if isinstance(source, str) else source, table, checkpoint, until_caught_up=seconds is None)
    if not query.awaitTermination(seconds) if seconds is not None else query.awaitTermination():
        query.stop()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    figures = progress(query)
    if runs is not None:
        record_run(runs, uuid.uuid4().hex, replay_day, started, datetime.now(timezone.utc), figures)
    return figures


def summary(table: DataFrame, figures: dict[str, int]) -> dict[str, int]:
    """A run's figures with the windows and trips its table holds."""
    r = table.agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("trips"), F.lit(0)).alias("trips")).first()
    return {"windows": r["windows"], "trips": r["trips"], **figures}


def dropped_in_runs(runs: DataFrame, replay_day=None) -> DataFrame:
    """How many runs there were and how many rows the engine dropped in them: of all runs, or of one replayed day."""
    kept = runs if replay_day is None else runs.where(F.col("replay_day") == F.lit(replay_day))
    return kept.agg(F.count(F.lit(1)).alias("runs"), F.coalesce(F.sum("dropped_late_rows"), F.lit(0)).alias("dropped_late_rows"))


def send_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Send events as JSON messages keyed by zone; needs the Kafka connector on the class path."""
    body = F.to_json(F.struct("event_id", "hvfhs_license_num", "pickup_zone_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time")))
    messages = events.select(F.col("pickup_zone_id").cast("string").alias("key"), body.alias("value"))
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.enable.idempotence", "true").option("topic", topic).save()


def reset(spark: SparkSession, *folders: str) -> None:
    """Remove a stream's source, table, run log and checkpoint."""
    for f in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def batch_model(events: DataFrame, batch: str, allowed_minutes: int = 30) -> DataFrame:
    """What the stream makes of numbered micro-batches: events with ``window_start`` and ``dropped``, exactly counted.

    The watermark of a batch is the greatest event time of the batches before, less what is allowed; the late filter
    uses the watermark of the batch before, and drops an event whose window ended at or before it.
    """
    tops = events.groupBy(batch).agg(F.max("event_time").alias("top"))  # a row per micro-batch
    marks = tops.select(F.col(batch).alias("__k"), F.max("top").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -2)).alias("mark"))
    rows = events.join(bounded_broadcast(marks, 100_000), events[batch] == marks["__k"]).drop("__k")
    start = F.window("event_time", WINDOW)["start"]
    late = F.coalesce(start + F.expr(f"INTERVAL {WINDOW}") <= F.col("mark") - F.expr(f"INTERVAL {allowed_minutes} MINUTES"), F.lit(False))
    return rows.withColumns({"window_start": start, "dropped": late}).drop("mark")
