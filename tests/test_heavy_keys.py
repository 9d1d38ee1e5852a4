import random
from collections import Counter

from pyspark.sql import functions as F

from tripmart.operators import heavy_keys as H

DDL = "data_month string, lic string, zone int, pay double, n bigint, __salt int"


def table(spark, rows):
    return spark.createDataFrame(rows, DDL)


def some(seed=1, n=4000):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["a", "b", None]), rng.choice(["x"] * 8 + ["y", "z", None]), rng.choice([1] * 5 + [*range(2, 40), None]),
            rng.choice([None, 1.0, 2.5]), 7, 9
        ) for _ in range(n)
    ]


def test_salted_aggregate_equals_group_by(spark):
    df = table(spark, some())
    parts = [H.count("rows"), H.total("pay", F.col("pay")), H.smallest("least", F.col("pay")), H.largest("most", F.col("pay")), H.mean("mean", F.col("pay"))]
    got = H.salted_aggregate(df, ["lic", "zone"], parts, max_heavy=20, salts=7)
    want = df.groupBy("lic", "zone").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pay").alias("pay"), F.min("pay").alias("least"), F.max("pay").alias("most"),
        F.avg("pay").alias("mean")
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_heavy_groups_are_found_and_bounded(spark):
    df = table(spark, some()).withColumn("__key_hash", F.xxhash64("lic"))
    heavy = H.heavy_hashes(df.select("__key_hash"), 4)
    assert df.where("lic = 'x'").select("__key_hash").first()[0] in heavy and len(heavy) <= 8


def test_distinct_sketches_merge(spark):
    df = spark.range(20_000).select(F.lit("k").alias("lic"), F.col("id").alias("v"))
    assert abs(H.salted_aggregate(df, ["lic"], [H.distinct_estimate("d", F.col("v"))]).first()["d"] - 20_000) < 1500


def test_heavy_values_by_brute_force(spark):
    rows = some(3)
    counts = H.value_counts(table(spark, rows), {"data_month": F.col("data_month")}, {"lic": F.col("lic"), "zone": F.col("zone")})
    got = {tuple(r) for r in H.heavy_values(counts, ["data_month"], 0.05).select("data_month", "field_name", "key_value").collect()}
    want, months = set(), Counter(r[0] for r in rows)
    for name, i in (("lic", 1), ("zone", 2)):
        for (m, v), n in Counter((r[0], r[i]) for r in rows).items():
            if m is not None and v is not None and n >= 0.05 * months[m]:
                want.add((m, name, str(v)))
    assert {g for g in got if g[0] is not None} == want


def test_null_is_counted_but_no_value_and_ties_at_the_limit_count(spark):
    rows = [("a", None, 1, None, 0, 0)] * 19 + [("a", "x", 1, None, 0, 0)]
    got = H.heavy_values(H.value_counts(table(spark, rows), {"data_month": F.col("data_month")}, {"lic": F.col("lic")}), ["data_month"], 0.05).collect()
    assert [(r["key_value"], r["n"], r["scope_rows"]) for r in got] == [("x", 1, 20)]


def test_empty_table(spark):
    counts = H.value_counts(table(spark, []), {"data_month": F.col("data_month")}, {"lic": F.col("lic")})
    assert counts.count() == 0 and H.heavy_values(counts, ["data_month"], 0.05).count() == 0
