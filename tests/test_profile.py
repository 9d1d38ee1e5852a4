import math
import random
from datetime import date

from pyspark.sql import functions as F

from tripmart.operators import profile

DDL = "lic string, zone int, miles double, secs bigint, _source_file string, data_month date, feed string, n0 int"
CHECKS = [
    profile.Check("lic", pattern=r"^HV[0-9]{4}\z", distinct=True), profile.Check("zone", least=1, most=265, distinct=True),
    profile.Check("miles", least=0, median=True), profile.Check("secs", least=0)
]
JAN, FEB = date(2025, 1, 1), date(2025, 2, 1)


def load(month, feed, rows):
    return [(*r, f"f_2025-{month.month:02d}_{feed}.parquet" if feed else None, month, "x", 1) for r in rows]


def profiles(spark, rows):
    return profile.column_profiles(spark.createDataFrame(rows, DDL), "_source_file", "data_month", CHECKS)


def findings(spark, rows):
    return sorted((r["source_file"][2:-8], r["column_name"], r["finding"]) for r in profile.against_previous(profiles(spark, rows), CHECKS).collect())


GOOD = [(f"HV000{i % 5}", 1 + i % 20, 1.0 + i % 3, 60) for i in range(100)]


def test_findings_of_each_kind(spark):
    bad = [("HV0001" if i % 2 else "hv0001", 300 if i < 2 else 7, 3.0 * (1 + i % 3), None if i < 6 else -5 if i < 9 else 60) for i in range(100)]
    assert findings(spark, load(JAN, "a", GOOD) + load(FEB, "a", bad) + load(FEB, "b", bad)) == [
        ("2025-02_a", "lic", "distinct"), ("2025-02_a", "lic", "pattern"), ("2025-02_a", "miles", "median"), (
            "2025-02_a", "secs", "null_rate"
        ), ("2025-02_a", "secs", "range"), ("2025-02_a", "zone", "distinct"), ("2025-02_a", "zone", "range"),
        ("2025-02_b", "lic", "pattern"), ("2025-02_b", "secs", "range"), ("2025-02_b", "zone", "range"),
    ]


def test_limits_themselves_are_no_findings(spark):
    now = [(None if i < 5 else f"HV000{i % 5}", 266 if i < 1 else 1 + i % 20, 1.4 * (1.0 + i % 3), -1 if i < 1 else 60) for i in range(100)]
    assert findings(spark, load(JAN, "a", GOOD) + load(FEB, "a", now)) == []


def test_nulls_repeats_and_missing_loads(spark):
    nothing = [(None, None, None, None)] * 5
    p = {r["column_name"]: r for r in profiles(spark, load(JAN, "a", nothing)).collect()}
    assert p["lic"]["nulls"] == 5 and p["lic"]["distinct_values"] == 0 and p["miles"]["median_value"] is None and p["miles"]["distinct_values"] is None
    assert profiles(spark, load(JAN, None, GOOD)).count() == 0 and profiles(spark, []).count() == 0
    assert profiles(spark, load(JAN, "a", GOOD + GOOD)).where("column_name = 'zone'").first()["row_count"] == 200
    # a trailing line break is no part of the form; NaN and infinity don't break the median
    odd = profiles(spark, load(JAN, "a", [("HV0001\n", 1, float("nan"), 1), ("HV0001", 1, float("inf"), 1), ("HV0001", 1, 2.0, 1)]))
    r = {x["column_name"]: x for x in odd.collect()}
    assert r["lic"]["violations"] == 1 and r["miles"]["median_value"] == 2.0


def test_recorded_figures(spark):
    p = profiles(spark, load(JAN, "a", GOOD + [(None, 999, 1.0, 1)]))
    recorded = spark.createDataFrame(
        [
            ("f_2025-01_a.parquet", "lic", 2, None), ("f_2025-01_a.parquet", "zone", 0, 3), ("f_2025-01_a.parquet", "zone", 0, 3),
            ("f_2025-01_a.parquet", "miles", 0, None), ("gone", "lic", 5, None)
        ],
        "source_file string, column_name string, nulls bigint, zones_out_of_range bigint"
    )
    assert sorted((r[1], r[2]) for r in profile.against_records(p, recorded, ["zone"]).collect()) == [("lic", "recorded_nulls"), ("zone", "recorded_zones")]


def test_rule_rates(spark):
    ddl = "source_file string, data_month date, rule_id string, matched_rows bigint, total_rows bigint"
    rows = [
        ("x_1_a.p", JAN, "R", 10, 1000), ("x_1_a.p", JAN, "R", 10, 1000), ("x_2_a.p", FEB, "R", 21, 1000), ("x_1_a.p", JAN, "S", 10, 1000),
        ("x_2_a.p", FEB, "S", 20, 1000), ("x_1_a.p", JAN, "T", 1, 1000), ("x_2_a.p", FEB, "T", 19, 1000), ("x_1_b.p", JAN, "R", 0, 1000),
        ("x_2_b.p", FEB, "R", 20, 1000)
    ]
    got = profile.rule_rates(spark.createDataFrame(rows, ddl)).collect()
    assert sorted((r["source_file"], r["column_name"]) for r in got) == [("x_2_a.p", "R"), ("x_2_b.p", "R")]


def test_states_merge(spark):
    a, b = load(JAN, "a", GOOD), load(JAN, "b", [(None, 5, -2.0, 1), ("x", 0, 0.0, None)])
    df = spark.createDataFrame(a + b, DDL)
    merged = profile.merge_states(profile.column_states(df, "_source_file", "data_month", CHECKS), F.lit("all"))
    whole = profile.column_states(df.withColumn("_source_file", F.lit("all")), "_source_file", "data_month", CHECKS)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_figures_against_counting(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.choice(["HV0001", "HV0002", "bad", None, "HV12345"]), rng.choice([None, -4, 0, 1, 7, 265, 266, 999]),
            rng.choice([None, -1.5, 0.0, -0.0, 2.25, rng.uniform(0, 90)]), rng.choice([None, -3, 0, 60, 61])
        ) for _ in range(700)
    ]
    got = {r["column_name"]: r for r in profiles(spark, load(JAN, "a", rows)).collect()}
    for i, k in enumerate(CHECKS):
        v = [r[i] for r in rows if r[i] is not None]
        r = got[k.column]
        assert r["row_count"] == 700 and r["nulls"] == 700 - len(v)
        if k.pattern:
            good = [x for x in v if x in ("HV0001", "HV0002")]
            assert r["violations"] == len(v) - len(good) and r["distinct_values"] == 2 and r["min_value"] is None and r["negative_rows"] is None
            continue
        good = [x for x in v if x >= k.least and (k.most is None or x <= k.most)]
        assert r["violations"] == len(v) - len(good) and r["negative_rows"] == sum(x < 0 for x in v) and r["zero_rows"] == sum(x == 0 for x in v)
        assert r["min_value"] == min(v) and r["max_value"] == max(v) and r["distinct_values"] == (len(set(good)) if k.distinct else None)
        if k.median:
            true = sorted(v)[(len(v) + 1) // 2 - 1]
            assert r["median_low"] <= true <= r["median_high"] and abs(r["median_value"] - true) <= abs(true) / 64


def test_medians_near_the_ratio_are_settled_exactly(spark):
    """1.4 times the median itself is no finding, the next greater number is; bins alone can't tell."""
    base = [("HV0001", 1, 10.0 + i / 1000, 60) for i in range(101)]
    for last, want in ((10.05 * 1.4, []), (math.nextafter(10.05 * 1.4, 99), ["miles"])):
        now = [("HV0001", 1, last + (i - 50) / 1000, 60) for i in range(101)]
        df = spark.createDataFrame(load(JAN, "a", base) + load(FEB, "a", now), DDL)
        found = profile.settled(profiles(spark, load(JAN, "a", base) + load(FEB, "a", now)), df, "_source_file", CHECKS)
        assert [r["column_name"] for r in profile.against_previous(found, CHECKS).where("finding = 'median'").collect()] == want


def test_control_limits(spark):
    rows = []
    for m in range(1, 7):
        rows += load(date(2025, m, 1), "a", [(f"HV000{i % 5}", 1, 10.0 if m == 6 else 1.0 + (m % 2) * 0.1, 60) for i in range(20)])
    got = profile.control_limits(profiles(spark, rows)).collect()
    assert [(r["source_file"], r["column_name"], r["metric"]) for r in got] == [("f_2025-06_a.parquet", "miles", "median_value")]


def test_every_column_has_distinct_values_and_range(spark, tmp_path):
    from tripmart.plans import problems

    trips = spark.read.parquet("/root/testdata/sf0.001/trips.parquet")
    got = problems.p6_columns(spark, "/root/testdata/sf0.001").collect()
    assert {r["column_name"] for r in got} == set(trips.columns) - {"_source_file", "data_month"}
    exact = {
        r["_source_file"]: r for r in trips.where("_source_file is not null").groupBy("_source_file").agg(
            F.countDistinct("request_datetime").alias("times"), F.min("request_datetime").cast("string").alias("low"),
            F.countDistinct("tips").alias("tips"), F.max("wav_match_flag").alias("flag")
        ).collect()
    }
    by = {(r["source_file"], r["column_name"]): r for r in got}
    for load, e in exact.items():
        assert abs(by[load, "request_datetime"]["distinct_values"] - e["times"]) <= 0.06 * e["times"] and by[load, "request_datetime"]["least"] == e["low"]
        assert abs(by[load, "tips"]["distinct_values"] - e["tips"]) <= 0.06 * e["tips"] + 1 and by[load, "wav_match_flag"]["greatest"] == e["flag"]
    assert any(r["median_value"] is not None for r in got)
