import random
from collections import Counter
from datetime import date, timedelta

import pytest

from tripmart.operators import orphans as O
from tripmart.store import Bundle

FACTS = "trip_key bigint, zone int, day int, data_month date, period string, ref_column string"
DIM = "k int, first_loaded date, removed_on date"
M = {i: date(2025, i, 1) for i in range(1, 7)}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "orphans")


def lives(spark, dims, days=()):
    return O.parents(
        spark.createDataFrame(dims, DIM), "zone", "k", "first_loaded", "removed_on"
    ).unionByName(O.parents(spark.createDataFrame([(d,) for d in days], "k int"), "day", "k"))


def state(spark, root, facts, dims, days=()):
    f = spark.createDataFrame(facts, FACTS)
    st = O.OrphanState(spark, root, ("day",))
    st.replay(O.references(f, ["zone", "day"], "data_month"), lives(spark, dims, days))
    return f, st


def found(facts, st, **options):
    return sorted((r["trip_key"], r["ref_column"]) for r in O.orphan_rows(facts, st.read("found"), ["zone", "day"], "data_month", **options).collect())


def test_lives_nulls_repeats_and_clashing_columns(spark, root):
    facts = [
        (1, 7, 5, M[1], "x", "y"), (2, 7, 5, M[2], "x", "y"), (3, 7, 5, M[3], "x", "y"), (4, 7, 6, M[4], "x", "y"), (5, None, None, M[1], None, None),
        (6, 9, 5, M[2], "x", "y"), (6, 9, 5, M[2], "x", "y"), (7, 8, 5, None, "x", "y"), (8, 8, 4, None, "x", "y"), (9, 10, 5, M[2], "x", "y"),
    ]
    # 7: in force to 10 February and again from 30 April; 8: always; 10: a span that is empty
    dims = [
        (7, date(2024, 1, 1), date(2025, 2, 11)), (7, date(2025, 4, 30), None), (8, None, None), (8, None, None),
        (10, date(2025, 2, 1), date(2025, 2, 1)), (None, None, None)
    ]
    f, st = state(spark, root, facts, dims, days=(5, 6, 6))
    assert found(f, st) == [(3, "zone"), (6, "zone"), (6, "zone"), (8, "day"), (9, "zone")]
    assert len(found(f, st, broadcast_keys=0)) == 5


def test_boundaries(spark, root):
    dims = [(1, date(2025, 1, 31), date(2025, 3, 1)), (2, date(2025, 2, 1), date(2025, 2, 2))]
    f, st = state(spark, root, [(i, k, 5, M[m], "", "") for i, (k, m) in enumerate([(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)])], dims, days=(5,))
    assert found(f, st) == [(2, "zone"), (3, "zone"), (5, "zone")]


def test_arrival_resolves_and_deletion_reopens_in_snapshots(spark, root):
    facts = [(1, 1, 5, M[1], "", ""), (2, 1, 5, M[1], "", ""), (3, 2, 5, M[5], "", ""), (4, 3, 5, M[2], "", "")] + [(9, 3, 5, M[m], "", "") for m in (3, 4, 6)]
    dims = [(1, date(2025, 3, 15), date(2025, 5, 1)), (2, None, None), (3, None, None)]
    _, st = state(spark, root, facts, dims, days=(5,))
    rows = {(r["ref_column"], r["period"].month): r for r in st.read("snapshots").collect()}
    assert [rows["zone", m]["waiting"] for m in range(1, 7)] == [2, 2, 0, 0, 2, 2]
    assert rows["zone", 1]["orphans"] == 2 and rows["zone", 1]["orphan_keys"] == 1 and rows["day", 1]["orphans"] == 0
    assert [tuple(r) for r in st.read("pending").collect()] == [("zone", 1, 2, True)] and st.bundle.step() == 5


def brute(facts, dims, days):
    """Orphans per row, and per column and month the references, orphans and what waits at its end."""
    force = lambda k, low, high: any(d[0] == k and (d[1] or date.min) <= high and (d[2] or date.max) > low for d in dims)
    end = lambda m: M.get(m.month + 1, date(2025, 7, 1)) - timedelta(days=1)
    rows, report = [], {}
    for t, z, d, m, *_ in facts:
        rows += [(t, "zone")] * (z is not None and not force(z, m, end(m))) + [(t, "day")] * (d is not None and d not in days)
    orphan = Counter(rows)
    for m in sorted({f[3] for f in facts}):
        here, so_far = [f for f in facts if f[3] == m], [f for f in facts if f[3] <= m]
        wait = sum(orphan[f[0], "zone"] > 0 and not force(f[1], end(m), end(m)) for f in so_far if f[1] is not None)
        report["zone", m] = (sum(f[1] is not None for f in here), sum(orphan[f[0], "zone"] > 0 for f in here), wait)
    return sorted(rows), report


def test_a_history_against_brute_force(spark, root):
    rng = random.Random(5)
    day = lambda: date(2025, 1, 1) + timedelta(days=rng.randrange(180))
    dims = []
    for k in range(12):
        cut = sorted({day() for _ in range(rng.choice([0, 1, 2, 3, 4]))})
        dims += [(k, a, b) for a, b in zip(cut[::2], [*cut[1::2], None])] + [(k, None, day())] * rng.choice([0, 0, 1])
    facts = [(i, rng.choice([None, *range(14)]), rng.choice([5, 6, 7]), M[rng.randrange(1, 7)], "", "") for i in range(400)]
    f, st = state(spark, root, facts, dims, days=(5, 6))
    rows, report = brute(facts, dims, (5, 6))
    assert found(f, st) == rows
    assert {("zone", r["period"]): (r["references"], r["orphans"], r["waiting"]) for r in st.read("snapshots").where("ref_column = 'zone'").collect()} == report


def test_increments_that_fail_or_come_again(spark, root, monkeypatch):
    f = spark.createDataFrame([(1, 1, 5, M[1], "", ""), (2, 1, 5, M[2], "", "")], FACTS)
    refs, nothing = O.references(f, ["zone"], "data_month"), spark.createDataFrame([], O.SPAN)
    st = O.OrphanState(spark, root)
    first = (0, M[1], refs.where("period = '2025-01-01'"), nothing, nothing)
    st.advance(*first)
    st.advance(*first)
    arrives = O.parents(spark.createDataFrame([(1, M[2], None)], DIM), "zone", "k", "first_loaded", "removed_on")
    second = (1, M[2], refs.where("period = '2025-02-01'"), arrives, nothing)
    monkeypatch.setattr(Bundle, "_append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        st.advance(*second)
    monkeypatch.undo()
    assert [tuple(r) for r in st.read("pending").collect()] == [("zone", 1, 1, True)]
    st.advance(*second)
    assert [tuple(r) for r in st.read("pending").collect()] == [("zone", 1, 1, False)] and st.read("found").count() == 1
    gone = O.parents(spark.createDataFrame([(1, M[2], M[4])], DIM), "zone", "k", "first_loaded", "removed_on")
    st.advance(2, M[4], refs.where("false"), nothing, gone)
    assert [tuple(r) for r in st.read("pending").collect()] == [("zone", 1, 1, True)]


def test_empty_tables(spark, root):
    f, st = state(spark, root, [], [], days=())
    assert found(f, st) == [] and st.read("snapshots").count() == 0
    f, st = state(spark, root + "2", [(1, 1, 1, M[1], "", "")], [])
    assert found(f, st) == [(1, "day"), (1, "zone")]


def test_no_frame_of_an_increment_is_made_twice(spark, root, monkeypatch):
    """References meet the index once an increment and wait once: two joins, however much is counted of them."""
    plans, write = [], Bundle._write
    monkeypatch.setattr(Bundle, "_write", lambda self, df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(self, df))[1])
    _, st = state(spark, root, [(1, 1, 5, M[1], "", ""), (2, 1, 5, M[2], "", ""), (3, 2, 5, M[3], "", "")], [(1, M[2], None)], days=(5,))
    assert st.bundle.step() == 2 and sum(line.lstrip(" :+-").startswith("Join") for p in plans for line in p.split("\n")) == 2 * 3
