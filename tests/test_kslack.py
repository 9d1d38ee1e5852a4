import os
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart.operators import kslack
from tripmart.store import Bundle
from tripmart.streaming.slack import SlackStream

DDL = "event_date date, event_id string, pickup_zone_id int, event_time timestamp, send_time timestamp, late string, seen int"
GROUPS = ["event_date", "pickup_zone_id"]
D0 = date(2025, 1, 6)
T0 = datetime(2025, 1, 6)


def row(i, minute, sent, zone=1, day=D0):
    return (day, i, zone, None if minute is None else T0 + timedelta(minutes=minute), None if sent is None else T0 + timedelta(minutes=sent), "x", 1)


def judged(spark, rows):
    df = kslack.first_sendings(spark.createDataFrame(rows, DDL), "event_date", "event_id", "send_time")
    return kslack.judged(kslack.ranged(df, "event_date", "send_time"), "event_date", "event_time", ["pickup_zone_id"], 15, 30)


def windows(events, **options):
    return kslack.with_late(kslack.final_windows(events, GROUPS, "event_id", **options), events.where("late"), GROUPS)


def brute(rows):
    first = {}
    for r in rows:
        if r[1] is not None and r[4] is not None and ((r[0], r[1]) not in first or r[4] < first[r[0], r[1]][4]):
            first[r[0], r[1]] = r
    days = defaultdict(list)
    for r in first.values():
        if r[3] is not None and r[2] is not None:
            days[r[0]].append(r)
    late = set()
    for day in days.values():
        for r in day:
            seen = max((o[3] for o in day if o[4] < r[4]), default=None)
            end = r[3] - timedelta(minutes=r[3].minute % 15, seconds=r[3].second, microseconds=r[3].microsecond) + timedelta(minutes=15)
            if seen is not None and end <= seen - timedelta(minutes=30):
                late.add(r[1])
    return late


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        m = rng.uniform(0, 600)
        day = D0 + timedelta(days=rng.randrange(2))
        r = row(f"e{i}", rng.choice([m] * 20 + [None]), m + rng.expovariate(1 / 30), rng.choice([1, 2, 3, None]), day)
        rows += [r] + ([(r[0], r[1], r[2], r[3], r[4] + timedelta(minutes=50), "y", 2)] if rng.random() < 0.1 else [])
    got = judged(spark, rows)
    want = brute(rows)
    assert {r["event_id"] for r in got.where("late").collect()} == want and len(want) > 20
    assert windows(got).agg({"late_trips": "sum"}).first()[0] == len(want)
    assert kslack.with_final(
        kslack.revisions(got, GROUPS, every_minutes=15), GROUPS
    ).where("is_final").agg({"trips_so_far": "sum"}).first()[0] == got.where("not late").count()


def test_the_limit_itself_is_late_and_equal_sendings_do_not_precede(spark):
    rows = [row("a", 60, 1), row("b", 15, 2), row("c", 14, 3), row("d", 59, 4), row("x", 200, 5), row("y", 10, 5)]
    # seen 60: windows that end at 30 or before are late: c (0-15) and b (15-30); y is sent with x
    assert {r["event_id"] for r in judged(spark, rows).where("late").collect()} == {"b", "c", "y"}
    assert {r["event_id"] for r in judged(spark, [row("x", 200, 5), row("y", 10, 5)]).where("late").collect()} == set()


def test_only_first_sendings_count_and_nulls_are_left_out(spark):
    rows = [row("a", None, 1), row("a", 300, 2), row("b", 10, 3), row("b", 10, 90), row(None, 500, 1), row("c", 500, None), row("d", 500, 1, zone=None)]
    got = judged(spark, rows).collect()
    assert [(r["event_id"], r["late"]) for r in got] == [("b", False)]


def test_final_windows_are_ordered_by_event_time(spark):
    rows = [row("a", 10, 1), row("b", 2, 2), row("c", 5, 3), row("d", 120, 4), row("e", 3, 5)]
    r = windows(judged(spark, rows)).where("trips = 3").first()
    assert (r["first_event"], r["last_event"], r["longest_gap_seconds"], r["late_trips"]) == ("b", "a", 300, 1)


def test_empty_table(spark):
    got = judged(spark, [])
    assert got.count() == 0 and windows(got).count() == 0


def test_windows_put_in_order_in_pieces_are_those_of_one_sort(spark):
    rng = random.Random(3)
    rows = [row(f"e{i}", rng.choice([rng.uniform(0, 90), rng.randrange(0, 90)]), i / 10, rng.choice([1, 1, 1, 2])) for i in range(500)]
    got = judged(spark, rows).cache()
    one, many = windows(got, piece_seconds=10**6), windows(got, piece_seconds=7)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty() and many.where("longest_gap_seconds > 0").count() > 5


def sendings(seed=5, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        m = rng.uniform(0, 400)
        r = row(f"e{i}", m, m + rng.expovariate(1 / 25), rng.choice([1, 2, None] if i % 40 == 0 else [1, 2]), D0 + timedelta(days=rng.randrange(2)))
        rows += [r] + ([(*r[:4], r[4] + timedelta(minutes=45), "y", 2)] if rng.random() < 0.1 else [])
    return sorted(rows, key=lambda r: r[4])


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_increments_equal_one_pass(spark, tmp_path):
    rows = sendings()
    whole = judged(spark, rows).cache()
    stream = SlackStream(str(tmp_path / "s"))
    cuts = [0, 60, 61, 200, len(rows)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        stream.add(spark.createDataFrame(rows[a:b], DDL), k)
        stream.add(spark.createDataFrame(rows[a:b], DDL), k)  # comes again after a restart
    got_late = {r["event_id"] for r in stream.read(spark, "late").collect()}
    assert got_late == {r["event_id"] for r in whole.where("late").collect()} and len(got_late) > 5
    want = kslack.final_windows(whole, GROUPS, "event_id")
    final, provisional = stream.read(spark, "final"), stream.read(spark, "provisional")
    assert final.count() > 0 and provisional.count() > 0
    assert same(final.unionByName(provisional), want)
    stream.close(spark, [D0])
    assert stream.read(spark, "provisional").where(F.col("event_date") == F.lit(D0)).isEmpty() and not stream.read(spark, "ids").isEmpty()
    stream.close(spark)
    assert same(stream.read(spark, "final"), want) and stream.read(spark, "provisional").isEmpty() and stream.read(spark, "ids").isEmpty()


def test_a_table_in_batches_publishes_what_one_pass_does(spark, tmp_path):
    rows = sendings(8, 300)
    whole = judged(spark, rows).cache()
    stream = SlackStream(str(tmp_path / "s"))
    stream.take(spark.createDataFrame(rows, DDL), least_batches=4)
    assert stream.bundle(spark).step() == 3
    assert same(stream.read(spark, "published"), kslack.revisions(whole, GROUPS, every_minutes=15))
    stream.close(spark)
    assert same(kslack.with_late(stream.read(spark, "final"), stream.read(spark, "late"), GROUPS), windows(whole))
    empty = SlackStream(str(tmp_path / "e"))
    empty.take(spark.createDataFrame([], DDL))
    assert empty.read(spark, "late").isEmpty() and empty.read(spark, "final").isEmpty()


@pytest.mark.parametrize("lost", range(9))
def test_a_batch_that_fails_anywhere_may_run_again(spark, tmp_path, monkeypatch, lost):
    """The second batch fails at each of its writes in turn, at last at the commit, and is taken in again."""
    rows = sendings(7, 120)
    whole = judged(spark, rows).cache()
    stream = SlackStream(str(tmp_path / "s"))
    stream.add(spark.createDataFrame(rows[:60], DDL), 0)
    write, append, calls = Bundle._write, Bundle._append, []

    def failing(self, df):
        folder = write(self, df)
        calls.append(1)
        if len(calls) == lost + 1:
            raise RuntimeError("lost")
        return folder

    def refused(self, before, entry):
        raise RuntimeError("lost")

    monkeypatch.setattr(Bundle, "_write", failing)
    if lost >= 7:
        monkeypatch.setattr(Bundle, "_append", refused)
    with pytest.raises(RuntimeError, match="lost"):
        stream.add(spark.createDataFrame(rows[60:], DDL), 1)
    monkeypatch.setattr(Bundle, "_write", write)
    monkeypatch.setattr(Bundle, "_append", append)
    assert stream.bundle(spark).step() == 0
    stream.add(spark.createDataFrame(rows[60:], DDL), 1)
    stream.close(spark)
    assert same(kslack.with_late(stream.read(spark, "final"), stream.read(spark, "late"), GROUPS), windows(whole))


def test_appended_parts_stay_few_folders(spark, tmp_path):
    b = Bundle(spark, str(tmp_path / "b"), most_folders=3)
    for k in range(8):
        b.commit(k, append={"x": spark.createDataFrame([(k,)], "k int")})
        assert len(b._last()[1]["parts"]["x"]["folders"]) <= 4
    assert sorted(r["k"] for r in b.read("x").collect()) == list(range(8)) and b.vacuum() and b.read("x").count() == 8 and b.read("y") is None


def test_increments_from_a_stream_of_files(spark, tmp_path):
    rows = sendings(6, 120)
    schema = spark.createDataFrame([], DDL).schema
    for k in range(3):
        part = rows[k * 45 : (k + 1) * 45]
        spark.createDataFrame(part, DDL).coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        file = next((tmp_path / f"p{k}").glob("*.parquet"))
        os.rename(file, tmp_path / "in" / f"{k}.parquet")
        os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = SlackStream(str(tmp_path / "s"))
    query = stream.run(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "c"))
    query.awaitTermination()
    want = {r["event_id"] for r in judged(spark, rows[:135]).where("late").collect()}
    assert query.exception() is None and {r["event_id"] for r in stream.read(spark, "late").collect()} == want
