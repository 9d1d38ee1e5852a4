"""The queries of the batch layers: contract, rules, aggregates, star, quality, measures, serving, profile, store."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import contract, layers, measures, profiling, quality, rules, serving, star
from tripmart.month import Month
from tripmart.session import checkpoint, checkpoint_dir
from tripmart.sources.tables import read
from tripmart.store import Table

CALENDAR = (date(2024, 1, 1), date(2025, 12, 31))
PERIOD = (date(2024, 11, 15), date(2025, 1, 31))


# tables ---------------------------------------------------------------------------------------------------------


def trips(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "trips")


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    return rules.evaluate(trips(spark, d))


def accepted(spark: SparkSession, d: str) -> DataFrame:
    return layers.silver(layers.with_zone_names(evaluated(spark, d), read(spark, d, "dim_zone")))


def rejected(spark: SparkSession, d: str) -> DataFrame:
    return evaluated(spark, d).where(F.size("failed_rules") > 0)


def passed(spark: SparkSession, d: str) -> DataFrame:
    """The accepted trips, stored: the rules are evaluated once for all that is made of them."""
    return checkpoint(evaluated(spark, d).where(F.size("failed_rules") == 0).select(*contract.NAMES, "data_month"))


def facts(spark: SparkSession, d: str) -> DataFrame:
    return star.fct_trips(passed(spark, d))


def companies(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "dim_company")


def counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.counts(evaluated(spark, d))


def zones(spark: SparkSession, d: str) -> DataFrame:
    lookup = layers.zone_lookup(read(spark, d, "dim_zone")).select(
        F.col("location_id").cast("string").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"),
        "service_zone"
    )
    return star.dim_zone(lookup)


def texts(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as comma-separated texts."""
    return df.withColumns({a: F.array_join(a, ",") for a in arrays})


# contract and rules ---------------------------------------------------------------------------------------------


def bronze_conform(spark: SparkSession, d: str) -> DataFrame:
    """Every month's file, as texts and without the late column, brought to the contract."""
    given = [F.col(n).cast("string").alias(n) for n in reversed(contract.NAMES) if n != "cbd_congestion_fee"]
    raw = trips(spark, d).where("data_month IS NOT NULL").select(*given, F.col("data_month").alias("of_month"))
    return contract.conform(raw, "of_month", "load.parquet").drop("_ingested_at")


def rule_flags(spark: SparkSession, d: str) -> DataFrame:
    return texts(
        evaluated(spark, d).select("_source_file", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "failed_rules", "quality_warnings"),
        "failed_rules", "quality_warnings"
    )


def silver_rows(spark: SparkSession, d: str) -> DataFrame:
    return texts(accepted(spark, d), "quality_warnings")


def quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    return texts(layers.quarantine(evaluated(spark, d)), "failed_rules", "quality_warnings")


def rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts(spark, d)


def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each layer per month."""
    flagged = evaluated(spark, d).select(
        "data_month",
        F.explode(F.array(F.lit("bronze"), F.when(F.size("failed_rules") == 0, F.lit("silver")).otherwise(F.lit("quarantine")))).alias("layer")
    )
    return flagged.groupBy("layer", "data_month").agg(F.count(F.lit(1)).alias("rows"))


def rerun_differences(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the quarantine before and after all of it is written again that differ, both ways: none."""
    table = _table(spark, "rerun")
    for _ in range(2):
        table.replace(rejected(spark, d).drop("_ingested_at"))
    before, after = table.read(0), table.read(1)
    return before.exceptAll(after).unionAll(after.exceptAll(before)).agg(F.count(F.lit(1)).alias("differences")).withColumn("rows", F.lit(after.count()))


# aggregates -----------------------------------------------------------------------------------------------------


def daily(spark: SparkSession, d: str) -> DataFrame:
    return layers.daily_company_trips(accepted(spark, d), companies(spark, d))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return layers.hourly_pickup_zones(accepted(spark, d))


def economics(spark: SparkSession, d: str) -> DataFrame:
    return layers.monthly_driver_economics(accepted(spark, d), companies(spark, d))


def top_companies(spark: SparkSession, d: str) -> DataFrame:
    return layers.with_company(
        accepted(spark, d).groupBy("hvfhs_license_num").agg(F.count(F.lit(1)).alias("trips")), companies(spark, d)
    ).select("company", "trips").orderBy(F.desc("trips"), "company").limit(10)


# star -----------------------------------------------------------------------------------------------------------


def dim_company(spark: SparkSession, d: str, accepted_trips: DataFrame | None = None) -> DataFrame:
    known = layers.company_names(companies(spark, d)).select(F.col("__licence").alias("hvfhs_license_num"), F.col("__name").alias("company_name"))
    return star.dim_company(known, evaluated(spark, d).where(F.size("failed_rules") == 0) if accepted_trips is None else accepted_trips)


def company_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys made for the licences of the given companies, against the given keys."""
    return companies(spark, d).where("hvfhs_license_num IS NOT NULL").select(
        "hvfhs_license_num", star.company_key(F.col("hvfhs_license_num")).alias("company_key")
    ).distinct()


def dimensions(spark: SparkSession, d: str, accepted_trips: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    z = checkpoint(zones(spark, d))
    return {
        "date_key": (star.dim_date(spark, CALENDAR), "date_key"), "time_key": (star.dim_time(spark), "time_key"),
        "pickup_zone_key": (z, "zone_key"), "dropoff_zone_key": (z, "zone_key"),
        "company_key": (checkpoint(dim_company(spark, d, accepted_trips)), "company_key")
    }


def fct_trips(spark: SparkSession, d: str) -> DataFrame:
    """The facts with the keys that the given companies have too; the made-up key of another licence is null here."""
    given = layers.bounded_broadcast(companies(spark, d).select(F.col("company_key").alias("__given")).distinct(), 100_000)
    rows = facts(spark, d).drop("trip_key")
    return rows.join(given, F.col("company_key") == F.col("__given"), "left").withColumn("company_key", F.col("__given")).drop("__given")


def trip_key_unique(spark: SparkSession, d: str) -> DataFrame:
    return facts(spark, d).agg(
        F.count(F.lit(1)).alias("trips"), F.countDistinct("trip_key").alias("keys"),
        F.count_if(F.col("wait_time_seconds").isNull()).alias("no_wait")
    )


def fct_trips_hourly(spark: SparkSession, d: str) -> DataFrame:
    stored = passed(spark, d)
    h, c = star.fct_trips_hourly(star.fct_rows(stored)), dim_company(spark, d, stored).select(F.col("company_key").alias("k"), "hvfhs_license_num")
    return h.join(layers.bounded_broadcast(checkpoint(c), 100_000), F.col("company_key") == F.col("k"), "left").drop("company_key", "k")


def orphan_checks(spark: SparkSession, d: str) -> DataFrame:
    """The given facts against the given dimensions; a null key finds no row."""
    z = read(spark, d, "dim_zone")
    keys = {
        "date_key": (read(spark, d, "dim_date"), "date_key"), "time_key": (star.dim_time(spark), "time_key"),
        "pickup_zone_key": (z, "zone_key"), "dropoff_zone_key": (z, "zone_key"), "company_key": (companies(spark, d), "company_key")
    }
    return star.orphan_counts(read(spark, d, "fct_trips"), keys)


def star_checks(spark: SparkSession, d: str) -> DataFrame:
    stored, table = passed(spark, d), _table(spark, "facts")  # checked as written, like the pipeline's
    table.replace(star.fct_trips(stored))
    f = table.read()
    return star.checks(stored.count(), f, star.fct_trips_hourly(f), dimensions(spark, d, stored))


# quality --------------------------------------------------------------------------------------------------------


def quality_monthly(spark: SparkSession, d: str) -> DataFrame:
    return quality.shown(quality.monthly_summary(counts(spark, d), rejected(spark, d)), "months")


def rule_rates(spark: SparkSession, d: str) -> DataFrame:
    return quality.shown(quality.rule_rates(counts(spark, d)), "rules")


def quarantine_by_company(spark: SparkSession, d: str) -> DataFrame:
    return quality.shown(quality.quarantine_by_company(rejected(spark, d), companies(spark, d)), "companies")


def dashboard_counters(spark: SparkSession, d: str) -> DataFrame:
    return quality.counters(quality_monthly(spark, d), rule_rates(spark, d))


def rate_by_month_rule(spark: SparkSession, d: str) -> DataFrame:
    return rule_rates(spark, d).select("data_month", "rule_id", "severity", "match_rate")


def spike_table(spark: SparkSession, d: str) -> DataFrame:
    return quality.spikes(rule_rates(spark, d))


def quarantine_by_rule_month(spark: SparkSession, d: str) -> DataFrame:
    return quality.by_rule_month(quarantine_by_company(spark, d))


# measures over the given facts ----------------------------------------------------------------------------------


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return star.fct_trips_hourly(read(spark, d, "fct_trips"))


def _calendar(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "dim_date").select("date_key", "month_start", "is_weekend")


def _zone_flags(spark: SparkSession, d: str) -> DataFrame:
    return zones(spark, d).select("zone_key", "is_airport")


def measures_by_month(spark: SparkSession, d: str) -> DataFrame:
    rows = measures.star(_hourly(spark, d), date=_calendar(spark, d), zone=_zone_flags(spark, d))
    return measures.with_previous_month(measures.by(rows, ["month_start"], {n: m() for n, m in measures.OVERVIEW.items()})).orderBy("month_start")


def measures_by_company(spark: SparkSession, d: str) -> DataFrame:
    names = companies(spark, d).select("company_key", "company_name")
    rows = measures.star(_hourly(spark, d), company=names, date=_calendar(spark, d))
    return measures.share_of_all(
        measures.by(rows, ["month_start", "company_name"], {"total_revenue": measures.revenue(), "total_trips": measures.trips()}),
        "total_revenue", ["month_start"]
    ).orderBy("month_start", F.desc("total_revenue"))


def executive_totals(spark: SparkSession, d: str) -> DataFrame:
    """The figures at the head of the executive page, over all facts."""
    return measures.by(
        _hourly(spark, d), [],
        {
            "total_trips": measures.trips(), "total_revenue": measures.revenue(), "avg_fare": measures.average_fare(),
            "avg_wait_minutes": measures.average_wait_minutes(), "driver_pay_share": measures.driver_pay_share()
        }
    )


def months_loaded(spark: SparkSession, d: str) -> DataFrame:
    return trips(spark, d).agg(F.countDistinct("data_month").alias("months"))


def airport_dropoffs(spark: SparkSession, d: str) -> DataFrame:
    rows = measures.star(read(spark, d, "fct_trips"), zone=_zone_flags(spark, d), zone_role="dropoff_zone_key")
    return rows.groupBy("data_month").agg(F.count(F.lit(1)).alias("trips"), F.count_if("is_airport").alias("airport_dropoffs"))


def weekday_peak_share(spark: SparkSession, d: str) -> DataFrame:
    rows = measures.star(_hourly(spark, d), date=_calendar(spark, d), time=star.dim_time(spark).select("time_key", "is_peak_hour"))
    return measures.by(rows, ["month_start"], {"weekday_peak_share": measures.weekday_peak_share()})


# serving, profile, store ----------------------------------------------------------------------------------------


def api_economics(spark: SparkSession, d: str) -> DataFrame:
    return serving.driver_economics(economics(spark, d), "2025-01")


def api_daily(spark: SparkSession, d: str) -> DataFrame:
    return serving.daily_trips(daily(spark, d), *PERIOD)


def api_busiest(spark: SparkSession, d: str) -> DataFrame:
    return serving.busiest_zones(hourly(spark, d), economics(spark, d), "2025-01", hour=8, limit=20)


def api_quality(spark: SparkSession, d: str) -> DataFrame:
    return texts(serving.monthly_quality(quality_monthly(spark, d), counts(spark, d)), "spike_rules")


def profile_columns(spark: SparkSession, d: str) -> DataFrame:
    return profiling.columns(trips(spark, d)).drop("p50", "p99")


def profile_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return profiling.columns(trips(spark, d)).select("data_month", "column_name", "p50", "p99").where("p50 IS NOT NULL")


def duplicate_stats(spark: SparkSession, d: str) -> DataFrame:
    return profiling.duplicates(trips(spark, d), rules.IDENTITY)


def flag_top10(spark: SparkSession, d: str) -> DataFrame:
    return profiling.frequent_flags(trips(spark, d))


def timestamp_checks(spark: SparkSession, d: str) -> DataFrame:
    return profiling.timestamps(trips(spark, d))


def _table(spark: SparkSession, name: str) -> Table:
    return Table(spark, f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}")


def upsert_company(spark: SparkSession, d: str) -> DataFrame:
    """Companies known, then those seen in trips: known ones stay, later ones join."""
    table = _table(spark, "company")
    seen = dim_company(spark, d).select("hvfhs_license_num", "company_name")
    table.upsert(seen.where("company_name LIKE 'Other%'").withColumn("company_name", F.lit("?")), ["hvfhs_license_num"])
    table.upsert(seen, ["hvfhs_license_num"])
    return table.read()


def replace_month_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Two months written, one of them twice and one emptied: rows per month of the table."""
    table, rows = _table(spark, "months"), trips(spark, d).select("hvfhs_license_num", "pickup_datetime", "trip_miles", "data_month")
    for text, kept in (("2025-01", True), ("2025-02", True), ("2025-01", True), ("2025-03", True), ("2025-03", False)):
        month = Month.parse(text)
        table.replace_month(rows.where((F.col("data_month") == F.lit(month.first)) & F.lit(kept)), month)
    return table.read().groupBy("data_month").agg(F.count(F.lit(1)).alias("trips"))


QUERIES = {
    "bronze_conform": bronze_conform, "rule_flags": rule_flags, "silver_rows": silver_rows, "quarantine_rows": quarantine_rows, "rule_counts": rule_counts, "layer_counts": layer_counts, "rerun_differences": rerun_differences,
    "daily_company_trips": daily, "hourly_pickup_zones": hourly, "monthly_driver_economics": economics, "top_companies": top_companies,
    "dim_date": lambda spark, d: star.dim_date(spark), "dim_time": lambda spark, d: star.dim_time(spark), "dim_zone": zones,
    "dim_company": lambda spark, d: dim_company(spark, d).drop("company_key"), "company_keys": company_keys, "fct_trips": fct_trips,
    "trip_key_unique": trip_key_unique, "fct_trips_hourly": fct_trips_hourly, "orphan_checks": orphan_checks, "star_checks": star_checks,
    "quality_monthly": quality_monthly, "rule_rates_spikes": rule_rates, "quarantine_by_company": quarantine_by_company, "dashboard_counters": dashboard_counters,
    "rate_by_month_rule": rate_by_month_rule, "spike_table": spike_table, "quarantine_by_rule_month": quarantine_by_rule_month,
    "executive_totals": executive_totals, "months_loaded": months_loaded, "measures_by_month": measures_by_month, "measures_by_company": measures_by_company, "airport_dropoffs": airport_dropoffs, "weekday_peak_share": weekday_peak_share,
    "api_economics": api_economics, "api_daily": api_daily, "api_busiest": api_busiest, "api_quality": api_quality,
    "profile_columns": profile_columns, "profile_percentiles": profile_percentiles, "duplicate_stats": duplicate_stats, "flag_top10": flag_top10, "timestamp_checks": timestamp_checks,
    "upsert_company": upsert_company, "replace_month_rerun": replace_month_rerun,
}
