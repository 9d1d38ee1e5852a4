"""Commands of the engine: one step of a month each, replay, stream, reconciliation and timing."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from tripmart import pipeline, session, storage, timing
from tripmart.month import Month
from tripmart.sources import download
from tripmart.store import MissingInput


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripmart", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        c.add_argument("--data", default="data/raw", help="folder of the raw files")
        c.add_argument("--lake", default="data/lake", help="folder of the tables")
        c.add_argument("--dataset", default="fhvhv")
        if "month" in arguments:
            c.add_argument("--month", type=Month.parse, required=True)
        if "day" in arguments:
            c.add_argument("--day", type=date.fromisoformat, required=True)
        if "out" in arguments:
            c.add_argument("--out", required=True, help="folder to write to")
        return c

    d = command("download", "month")
    d.add_argument("--url", required=True, help="address of the monthly files")
    d.add_argument("--zones-url", help="address of the zone lookup, by default beside the monthly files")
    command("profile", "month", "out")
    for step in ("bronze", "silver", "gold", "star"):
        command(step, "month")
    command("snapshot", "month", "out")
    command("export", "out")
    command("replay-extract", "day")
    r = command("replay", "day")
    r.add_argument("--late-share", type=float, default=0.02)
    r.add_argument("--most-minutes", type=float, default=90)
    r.add_argument("--seed", type=int, default=7)
    r.add_argument("--files", type=int, default=48, help="files to send, where no broker is named")
    r.add_argument("--speed", type=float, help="seconds of the day in one of ours; without it all is sent at once")
    st = command("stream", "day")
    st.add_argument("--files-per-trigger", type=int, default=1)
    st.add_argument("--most-offsets", type=int, default=50_000, help="messages a micro-batch")
    st.add_argument("--seconds", type=float, help="run live for so long; without it until all there is has been read")
    for c in (r, st):
        c.add_argument("--bootstrap", help="brokers; needs the Kafka connector on the class path")
        c.add_argument("--topic", default="pickups")
    command("reconcile", "day", "out")
    command("stream-reset")
    b = command("benchmark", "month")
    b.add_argument("--repeats", type=int, default=3)
    b.add_argument("--out", help="folder for the report")
    j = command("job", "month", "out")
    j.add_argument("--schema", default="mobility", help="catalog and schema of the tables' names")
    c = command("serve", "out")
    c.add_argument("--port", type=int, default=8080)
    t = command("job-timings")
    t.add_argument("--runs", required=True, help="the run history, JSON")
    t.add_argument("--out", help="folder for the report")
    return top


def main(argv: Sequence[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if a.command == "download":
        print(download.fetch_month(a.url, a.dataset, a.month, Path(a.data)))
        print(download.fetch_zones(a.zones_url or a.url, Path(a.data)))
        return 0
    if a.command == "job-timings":
        text = timing.job_report(timing.job_runs(Path(a.runs).read_text()))
        print(text)
        if a.out:
            Path(a.out).mkdir(parents=True, exist_ok=True)
            Path(a.out, "job.md").write_text(text)
        return 0
    lake = pipeline.Lake(spark or session.create(), storage.located(a.lake), storage.located(a.data), a.dataset, schema=getattr(a, "schema", None))
    try:
        return _run(a, lake)
    except MissingInput as missing:
        print(missing, file=sys.stderr)
        return 1


def _run(a: argparse.Namespace, lake: pipeline.Lake) -> int:
    from pyspark.sql import functions as F

    from tripmart.streaming import pickups, reconcile, replay

    stream = f"{lake.root}/stream"
    if a.command in ("bronze", "silver", "gold"):
        print(getattr(pipeline, f"run_{a.command}")(lake, a.month))
    elif a.command == "star":
        checks = pipeline.run_star(lake, a.month).collect()
        print(*checks, sep="\n")
        return 0 if all(c["passed"] for c in checks) else 1
    elif a.command == "profile":
        storage.write_text(lake.spark, f"{storage.located(a.out)}/{a.dataset}_{a.month}.md", pipeline.run_profile(lake, a.month))
    elif a.command == "snapshot":
        print(pipeline.run_snapshot(lake, a.month, storage.located(a.out)))
    elif a.command == "export":
        print(*pipeline.run_export(lake, storage.located(a.out)), sep="\n")
    elif a.command == "replay-extract":
        events = replay.events_of_day(lake.month("silver", Month.of(a.day)), a.day)
        events.drop("event_date").write.mode("overwrite").parquet(f"{lake.root}/events/event_date={a.day}")
    elif a.command == "replay":
        folder = f"{lake.root}/events/event_date={a.day}"
        if not storage.exists(lake.spark, folder):
            raise MissingInput(f"no events of {a.day}; run replay-extract first")
        planned = replay.planned_frame(lake.spark.read.parquet(folder), a.late_share, a.most_minutes, a.seed)
        print(replay.summary(planned).first())
        send = (lambda df, n: pickups.send_kafka(df, a.bootstrap, a.topic)) if a.bootstrap else (
            lambda df, n: replay.drop_files(df, f"{stream}/in", 1, f"{a.day}-{n:06d}-")
        )
        if a.speed or a.bootstrap:
            print(replay.paced(planned, send, a.files, a.speed))
        else:
            replay.drop_files(planned, f"{stream}/in", a.files, str(a.day))
    elif a.command == "stream":
        source = pickups.kafka_events(lake.spark, a.bootstrap, a.topic, a.most_offsets) if a.bootstrap else f"{stream}/in"
        print(
            pickups.run_until_caught_up(
                lake.spark, source, lake.table("stream/pickups"), f"{stream}/checkpoint", lake.table("stream/runs"), a.day,
                files_per_trigger=a.files_per_trigger, seconds=a.seconds
            )
        )
    elif a.command == "reconcile":
        events = lake.spark.read.parquet(f"{lake.root}/events/event_date={a.day}")
        files = lake.spark.read.schema(pickups.EVENT).json(f"{stream}/in").withColumn("file", F.input_file_name())
        dropped = pickups.batch_model(pickups.valid(files), "file").where(F.col("dropped") & (F.to_date("event_time") == F.lit(a.day))).count()
        verdict = reconcile.compare(
            reconcile.hourly_from_events(events),
            reconcile.hourly_from_windows(lake.table("stream/pickups").read().where(F.to_date("window_start") == F.lit(a.day))), dropped
        )
        storage.write_text(lake.spark, f"{storage.located(a.out)}/reconciliation_{a.day}.md", reconcile.report(str(a.day), verdict))
        print(verdict)
        return 0 if verdict.reconciled else 1
    elif a.command == "stream-reset":
        pickups.reset(lake.spark, stream)
    elif a.command == "serve":
        from tripmart import http_api

        http_api.server(http_api.Service(lake.spark, storage.located(a.out)), a.port).serve_forever()
    elif a.command == "benchmark":
        steps = {n: (lambda n=n: getattr(pipeline, f"run_{n}")(lake, a.month)) for n in ("bronze", "silver", "gold", "star")}
        text = timing.report(f"{a.dataset} {a.month}", timing.measure(steps, a.repeats)) + f"\nMonths in bronze: {pipeline.months_loaded(lake)}\n"
        if lake.table("stream/runs").exists():
            text += "\n" + timing.throughput_report(lake.table("stream/runs").read())
        print(text)
        if a.out:
            storage.write_text(lake.spark, f"{storage.located(a.out)}/benchmark_{a.dataset}_{a.month}.md", text)
    elif a.command == "job":
        done = pipeline.run_job(lake, a.month, storage.located(a.out))
        print(done)
        return 1 if done["star"] else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
