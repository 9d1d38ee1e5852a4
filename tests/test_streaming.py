import json
import os
import random
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from tests.trips import frame, trip
from tripmart import contract
from tripmart.month import Month
from tripmart.sources import download
from tripmart.store import Table
from tripmart.streaming import pickups, reconcile, replay

T0 = datetime(2025, 1, 15, 8)
DAY = date(2025, 1, 15)


def put(folder, name, *events):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(
        "".join(
            (
                e if isinstance(e, str) else json.dumps(
                    {"event_id": f"{name}{i}", "pickup_zone_id": e[0], "event_time": (T0 + timedelta(minutes=e[1])).isoformat()}
                )
            ) + "\n" for i, e in enumerate(events)
        )
    )


def counted(table):
    return {(r["window_start"].strftime("%H:%M"), r["pickup_zone_id"]): r["trips"] for r in table.read().collect()}


def test_late_events_over_three_runs(spark, tmp_path):
    table, runs = Table(spark, str(tmp_path / "t")), Table(spark, str(tmp_path / "r"))
    go = lambda: pickups.run_until_caught_up(spark, str(tmp_path / "in"), table, str(tmp_path / "c"), runs, DAY)
    put(tmp_path / "in", "1.json", (1, 0), (1, 5), (2, 10), (1, 20), (1, 40), (1, 60), "{broken", (None, 3))
    assert go()["dropped_late_rows"] == 0
    first = counted(table)
    assert first == {("08:00", 1): 2, ("08:00", 2): 1, ("08:15", 1): 1, ("08:30", 1): 1, ("09:00", 1): 1}
    put(tmp_path / "in", "2.json", (1, 10), (1, 35), (1, 70))  # the watermark stands at 08:30
    assert go()["dropped_late_rows"] == 1
    assert counted(table) == first | {("08:30", 1): 2, ("09:00", 1): 2}
    go()
    assert counted(table) == first | {("08:30", 1): 2, ("09:00", 1): 2} and runs.read().count() == 3


def test_batch_model_equals_the_stream(spark, tmp_path):
    rng = random.Random(8)
    folder, events = tmp_path / "in", []
    for k in range(8):
        batch = [(rng.choice([1, 2]), k * 30 + rng.uniform(0, 30) - rng.choice([0, 0, 0, rng.uniform(0, 200)])) for _ in range(60)]
        put(folder, f"{k}.json", *batch)
        os.utime(folder / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # files are read in the order of their times
        events += [(k, z, T0 + timedelta(minutes=m)) for z, m in batch]
    table = Table(spark, str(tmp_path / "t"))
    pickups.run_until_caught_up(spark, str(folder), table, str(tmp_path / "c"))
    model = pickups.batch_model(spark.createDataFrame(events, "k int, pickup_zone_id int, event_time timestamp"), "k")
    kept = {
        (
            r["window_start"].strftime("%d %H:%M"), r["pickup_zone_id"]
        ): r["n"] for r in model.where("not dropped").groupBy("window_start", "pickup_zone_id").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert kept == {(r["window_start"].strftime("%d %H:%M"), r["pickup_zone_id"]): r["trips"] for r in table.read().collect()}
    dropped = model.where("dropped").count()
    batch, stream = (f.withColumn("zone", F.col("zone") + 0) for f in (reconcile.hourly_from_events(model), reconcile.hourly_from_windows(table.read())))
    verdict = reconcile.compare(batch, stream, dropped)
    assert dropped > 5 and verdict.reconciled and "RECONCILED" in reconcile.report("x", verdict)
    assert not reconcile.compare(batch, stream, dropped - 1).reconciled


def test_cells(spark):
    b = spark.createDataFrame([(8, 1, 5), (8, 2, 5), (9, 1, 5)], "hour int, zone int, trips bigint")
    s = spark.createDataFrame([(8, 1, 5), (8, 2, 4), (10, 1, 1)], "hour int, zone int, trips bigint")
    v = reconcile.compare(b, s, 6)
    assert (v.equal, v.short, v.over, v.missing, v.reconciled) == (1, 2, 1, 6, False)


def test_parse_leaves_out_what_is_no_event(spark):
    good = {"event_id": "a", "hvfhs_license_num": None, "pickup_zone_id": 3, "event_time": "2025-01-15T08:00:00"}
    texts = [json.dumps(good), json.dumps(good | {"event_time": None}), json.dumps(good | {"pickup_zone_id": "x"}), "{", "", None]
    assert pickups.parse(spark.createDataFrame([(t,) for t in texts], "value string")).count() == 1


def test_plan_is_seeded():
    events = [replay.Event(f"e{i}", "HV", 1 + i % 5, T0 + timedelta(seconds=30 * i)) for i in range(500)]
    a, b = replay.plan(events), replay.plan(events)
    assert a == b and a != replay.plan(events, seed=8) and [p.send_time for p in a] == sorted(p.send_time for p in a)
    late = [p for p in a if p.delay_minutes]
    assert 2 <= len(late) <= 25 and all(1 <= p.delay_minutes <= 90 for p in late) and replay.plan(events, late_share=0)[0].delay_minutes == 0
    assert json.loads(events[0].message())["event_time"] == "2025-01-15T08:00:00"
    for wrong in ({"late_share": 2}, {"most_minutes": 0.5}):
        with pytest.raises(ValueError):
            replay.plan(events, **wrong)


def test_replay_keeps_the_pace():
    now, sent = [0.0], []
    planned = replay.plan([replay.Event("a", "H", 1, T0), replay.Event("b", "H", 1, T0 + timedelta(minutes=10))], late_share=0)
    assert replay.replay(planned, sent.append, 600, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s)) == 2
    assert now[0] == pytest.approx(1.0) and [e.event_id for e in sent] == ["a", "b"]


def test_a_day_is_numbered_in_order_and_sent_in_equal_files(spark, tmp_path):
    rows = [
        trip(i, pickup_datetime=datetime(2025, 1, 15, i * 7 % 24, i % 60), driver_pay=float(i)) for i in range(50)
    ] + [trip(1, pickup_datetime=datetime(2025, 1, 16))]
    day = replay.events_of_day(contract.conform(frame(spark, rows), Month(2025, 1), "f"), DAY)
    got = sorted((r["event_time"], int(r["event_id"].rpartition("-")[2])) for r in day.collect())
    assert [n for _, n in got] == list(range(1, 51))
    planned = replay.planned_frame(day)
    assert replay.summary(planned).first()["events"] == 50 and planned.exceptAll(replay.planned_frame(day.repartition(4))).isEmpty()
    replay.drop_files(planned, str(tmp_path / "in"), 6)
    sizes = [len(p.read_text().splitlines()) for p in sorted((tmp_path / "in").glob("*.json"))]
    assert sizes == [9, 9, 8, 8, 8, 8]
    assert [e.event_id for e in replay.read_events(day, DAY)][:2] == ["2025-01-15-1", "2025-01-15-2"]


class Answer(BytesIO):
    def __init__(self, body, size):
        super().__init__(body)
        self.headers = {"Content-Length": str(size)}


def test_download(tmp_path):
    asked = Counter()

    def opener(request, size=5, body=b"hello"):
        asked[request.get_method()] += 1
        return Answer(b"" if request.get_method() == "HEAD" else body, size)

    got = download.fetch_month("http://x", "fhvhv", Month(2025, 1), tmp_path, opener)
    assert got.path.name == "fhvhv_tripdata_2025-01.parquet" and got.path.read_bytes() == b"hello" and not got.skipped
    assert download.fetch_month("http://x", "fhvhv", Month(2025, 1), tmp_path, opener).skipped and asked == {"HEAD": 2, "GET": 1}
    with pytest.raises(OSError, match="of 9"):
        download.fetch("http://x/y", tmp_path / "y", lambda r: opener(r, 9))
    assert not (tmp_path / "y").exists() and not (tmp_path / "y.part").exists()


def test_run_log_replaces_a_run(spark, tmp_path):
    runs, at = Table(spark, str(tmp_path / "r")), datetime(2025, 1, 1, tzinfo=timezone.utc)
    for n in (1, 2):
        pickups.record_run(runs, "a", DAY, at, at, {"batches": n, "input_rows": n, "dropped_late_rows": 0})
    assert [r["batches"] for r in runs.read().collect()] == [2]


def test_runs_of_a_day(spark):
    at = datetime(2025, 1, 1, tzinfo=timezone.utc)
    rows = [("a", DAY, at, at, 1, 5, 2), ("b", DAY, at, at, 1, 5, 3), ("c", date(2025, 1, 16), at, at, 1, 5, 9)]
    runs = spark.createDataFrame(rows, pickups.RUN)
    assert tuple(pickups.dropped_in_runs(runs).first()) == (3, 14) and tuple(pickups.dropped_in_runs(runs, DAY).first()) == (2, 5) and tuple(
        pickups.dropped_in_runs(runs.limit(0), DAY).first()
    ) == (0, 0)


def test_a_plan_is_sent_in_parts_at_a_pace(spark):
    events = spark.createDataFrame([(f"e{i}", T0 + timedelta(seconds=10 * i)) for i in range(60)], "event_id string, send_time timestamp")
    now, sent = [0.0], []
    n = replay.paced(
        events, lambda df, k: sent.append(
            (now[0], [r["event_id"] for r in df.orderBy("send_time").collect()])
        ), 5, 60, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s)
    )
    assert n == 5 and [e for _, part in sent for e in part] == [f"e{i}" for i in range(60)] and [round(t) for t, _ in sent] == [0, 2, 4, 6, 8]
    assert replay.paced(events.limit(0), None, 5) == 0
    with pytest.raises(ValueError):
        replay.paced(events, None, 5, 0)


def test_the_zone_lookup_is_fetched(tmp_path):
    asked = []

    def opener(request):
        asked.append(request.full_url)
        return Answer(b"" if request.get_method() == "HEAD" else b"hello", 5)

    for url in ("http://x/misc", "http://x/misc/taxi_zone_lookup.csv"):
        assert download.fetch_zones(url, tmp_path, opener).path == tmp_path / "taxi_zone_lookup.csv"
    assert set(asked) == {"http://x/misc/taxi_zone_lookup.csv"}


def test_commands_replay_and_stream(spark, tmp_path):
    from tripmart import cli, pipeline

    lake = ["--lake", str(tmp_path / "lake"), "--data", str(tmp_path), "--day", str(DAY)]
    assert cli.main(["replay", *lake], spark=spark) == 1
    events = spark.createDataFrame(
        [(f"e{i}", "HV0001", 1 + i % 3, T0 + timedelta(minutes=i)) for i in range(90)],
        "event_id string, hvfhs_license_num string, pickup_zone_id int, event_time timestamp"
    )
    events.write.parquet(f"{tmp_path}/lake/events/event_date={DAY}")
    assert cli.main(["replay", *lake, "--late-share", "0", "--files", "3", "--speed", "1000000"], spark=spark) == 0
    assert len(list((tmp_path / "lake" / "stream" / "in").glob("*.json"))) == 3
    assert cli.main(["stream", *lake, "--files-per-trigger", "2"], spark=spark) == 0
    table = pipeline.Lake(spark, str(tmp_path / "lake"), str(tmp_path)).table("stream/pickups")
    assert table.read().agg(F.sum("trips")).first()[0] == 90
    assert cli.main(["stream", *lake, "--seconds", "3"], spark=spark) == 0 and table.read().agg(F.sum("trips")).first()[0] == 90
