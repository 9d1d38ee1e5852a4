"""What the plans read, shuffle and broadcast."""

import re
from datetime import date

from pyspark.sql import functions as F

from tests.trips import frame, trip
from tripmart import contract, layers, rules, star
from tripmart.functions.columns import licence, month_text
from tripmart.month import Month
from tripmart.operators import heavy_keys, orphans
from tripmart.store import Table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, tmp_path):
    rows = contract.conform(frame(spark, [trip(i) for i in range(60)] + [trip(1), trip(1)]), Month(2025, 1), "f")
    rows.write.parquet(str(tmp_path / "trips"))
    return spark.read.parquet(str(tmp_path / "trips"))


def read_columns(df):
    return {
        c for s in re.findall(
            r"ReadSchema: struct<([^>]*)",
            df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        ) for c in re.findall(r"(\w+):", s)
    }


def test_scans_read_only_the_columns_they_need(spark, tmp_path):
    trips = written(spark, tmp_path)
    counts = heavy_keys.value_counts(trips, {"m": month_text()}, {"l": licence(), "z": F.col("PULocationID")})
    assert read_columns(counts) == {"data_month", "hvfhs_license_num", "PULocationID"}


def test_rules_and_trip_keys_do_not_shuffle_wide_rows(spark, tmp_path):
    evaluated = rules.evaluate(written(spark, tmp_path))
    zones = spark.createDataFrame(
        [(1, 1, "B", "Z", None, date(2024, 1, 1))],
        "zone_key int, location_id int, borough string, zone string, service_zone string, first_loaded date"
    )
    silver = layers.silver(layers.with_zone_names(evaluated, zones))
    text = plan(silver)
    assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0] and "CartesianProduct" not in text and "NestedLoop" not in text
    keyed = plan(star.with_trip_key(silver, among=spark.read.parquet(str(tmp_path / "trips"))))
    alone = keyed[: keyed.index("Window")]
    assert "hashpartitioning" not in alone.split("BroadcastExchange")[0]


def test_no_join_without_a_condition(spark, tmp_path):
    facts = spark.createDataFrame([(1, 7, date(2025, 1, 1))], "trip_key bigint, zone int, data_month date")
    lives = orphans.parents(spark.createDataFrame([(7, None, None)], "k int, b date, e date"), "zone", "k", "b", "e")
    state, refs = orphans.OrphanState(spark, str(tmp_path / "o")), orphans.references(facts, ["zone"], "data_month")
    state.replay(refs, lives)
    assert not re.search(
        "CartesianProduct|NestedLoop",
        plan(state._unmet(refs, lives)) + plan(orphans.orphan_rows(facts, state.read("found"), ["zone"], "data_month"))
    )


def test_months_of_a_table_are_pruned_to_their_folders(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    for m in (1, 2):
        table.replace_month(spark.createDataFrame([(m, date(2025, m, 1))], "k int, data_month date"), Month(2025, m))
    one = table.read(months=[Month(2025, 2)])
    assert len(one.inputFiles()) < len(table.read().inputFiles()) and "PushedFilters: [IsNotNull(data_month)" in one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
