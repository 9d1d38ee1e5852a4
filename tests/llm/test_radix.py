import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import radix

POINTS = [1, 2500, 5000, 9000, 10000]


def exact(values, p):
    return sorted(values)[max(1, -(-p * len(values) // 10000)) - 1]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "g string, v double, bits int, field int").withColumn("__group", F.lit("x"))
    return {(r["k"], r["basis_points"]): r["value"] for r in radix.percentiles(df, {"k": F.col("g")}, {"v": F.col("v")}, POINTS, **options).collect()}


def check(spark, rows, **options):
    groups = {}
    for g, v, *_ in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v + 0.0)
    assert run(spark, rows, **options) == {(g, p): exact(v, p) for g, v in groups.items() for p in POINTS}


@pytest.mark.parametrize("options", [{}, {"broadcast_groups": 0}, {"gather": 0}, {"gather": 20, "broadcast_groups": 0}])
def test_against_sorting(spark, options):
    rng = random.Random(5)
    rows = [
        (
            rng.choice(["a", "b", None]),
            rng.choice([None, float("nan"), rng.gauss(0, 50), round(rng.uniform(-5, 90), 2), 1.0 + rng.randrange(9) * 2.0**-52]), 1, 2
        ) for _ in range(3000)
    ]
    check(spark, rows, **options)


def test_ties_single_values_and_no_values(spark):
    check(spark, [("a", 2.0, 0, 0)] * 50 + [("b", -1.5, 0, 0)] + [("c", None, 0, 0)])
    assert run(spark, []) == {}
    whole = radix.percentiles(spark.createDataFrame([(float(i),) for i in range(101)], "v double"), {}, {"v": F.col("v")}, [5000], gather=3).collect()
    assert [(r["value"], r["group_rows"]) for r in whole] == [(50.0, 101)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_any_doubles(spark, values):
    check(spark, [("g", v, 0, 0) for v in values], gather=0)


def test_merged_histograms_are_those_of_all_rows_and_bound_the_error(spark):
    rng = random.Random(6)
    rows = [(f"load{i % 4}", "g", rng.lognormvariate(3, 1)) for i in range(4000)]
    df = spark.createDataFrame(rows, "load string, g string, v double")
    single = radix.histogram(radix.measures(df, {"load": F.col("load"), "g": F.col("g")}, {"v": F.col("v")}), ["load", "g"])
    merged = radix.merge(single, ["g"])
    whole = radix.histogram(radix.measures(df, {"g": F.col("g")}, {"v": F.col("v")}), ["g"]).select(*merged.columns)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    for r in radix.bounded_percentiles(merged, ["g"], POINTS).collect():
        true = exact([v for *_, v in rows], r["basis_points"])
        assert r["low"] <= true <= r["high"] and abs(r["value"] - true) <= radix.RELATIVE_ERROR * true


def test_a_bin_never_holds_more_than_is_gathered(spark):
    """Many values close together are followed digit by digit until the bins are small."""
    rng = random.Random(4)
    rows = [("a", 1.0 + rng.randrange(2**30) * 2.0**-52, 0, 0) for _ in range(2000)]
    check(spark, rows, gather=10)


def test_plan(spark, tmp_path):
    """Two columns are read, and counts are combined before the shuffle."""
    spark.createDataFrame([("g", 1.0, 2.0)], "g string, v double, other double").write.parquet(str(tmp_path / "t"))
    hist = radix.histogram(radix.measures(spark.read.parquet(str(tmp_path / "t")), {"m": F.col("g")}, {"p": F.col("v")}), ["m"])
    text = hist._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<g:string,v:double>" in text and text.index("partial_count") > text.index("Exchange")
