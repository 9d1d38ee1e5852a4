"""The steps of a month: conformed load, accepted and rejected trips, aggregates, star, snapshot, export."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import contract, export, layers, profiling, quality, rules, star
from tripmart.month import Month
from tripmart.store import MissingInput, Table

SERVED = ("daily_company_trips", "hourly_pickup_zones", "monthly_driver_economics", "rule_counts", "quality_months")


@dataclass(frozen=True)
class Lake:
    """Where a data set's inputs and tables lie."""

    spark: SparkSession
    root: str
    raw: str
    dataset: str = "fhvhv"
    calendar: tuple[date, date] = star.CALENDAR
    #: Catalog and schema under which the tables are found by name too.
    schema: str | None = None

    def table(self, name: str) -> Table:
        named = f"{self.schema}.{name.replace('/', '_')}" if self.schema else None
        return Table(self.spark, f"{self.root}/{name}", named)

    def raw_file(self, month: Month) -> str:
        return f"{self.raw}/{self.dataset}/{self.dataset}_tripdata_{month}.parquet"

    def zones(self) -> DataFrame:
        """The zone lookup, a CSV with a header of texts."""
        schema = "LocationID string, Borough string, Zone string, service_zone string"
        return star.dim_zone(self.spark.read.schema(schema).option("header", True).csv(f"{self.raw}/taxi_zone_lookup.csv"))

    def companies(self) -> DataFrame:
        t = self.table("dim_company")
        return t.read().withColumn("first_loaded", F.lit(None).cast("date")) if t.exists() else self.spark.createDataFrame(
            [], "company_key bigint, hvfhs_license_num string, company_name string, first_loaded date"
        )

    def month(self, name: str, month: Month) -> DataFrame:
        """One month of a table; there must be rows."""
        t = self.table(name)
        if not t.exists():
            raise MissingInput(f"there is no {name} yet")
        rows = t.read(months=[month])
        if rows.isEmpty():
            raise MissingInput(f"{name} has no rows of {month}")
        return rows


def months_loaded(lake: Lake) -> int:
    """How many months the conformed trips have."""
    return lake.table("bronze").read().select("data_month").distinct().count()


def run_job(lake: Lake, month: Month, serving: str) -> dict[str, object]:
    """All steps of a month on tables the catalog knows, with the snapshot and the files of BI tools in ``serving``."""
    if lake.schema:
        lake.spark.sql(f"CREATE DATABASE IF NOT EXISTS {'.'.join(f'`{x}`' for x in lake.schema.split('.'))}")
    out: dict[str, object] = {n: run(lake, month) for n, run in (("bronze", run_bronze), ("silver", run_silver), ("gold", run_gold))}
    out["snapshot"] = run_snapshot(lake, month, f"{serving}/snapshot")
    out["star"] = [r["name"] for r in run_star(lake, month).where("NOT passed").collect()]
    out["export"] = [e.name for e in run_export(lake, f"{serving}/bi")]
    return out


def run_bronze(lake: Lake, month: Month) -> int:
    path = lake.raw_file(month)
    try:
        raw = lake.spark.read.parquet(path)
    except Exception as gone:
        if "PATH_NOT_FOUND" in str(gone):
            raise MissingInput(f"there is no file {path}") from gone
        raise
    lake.table("bronze").replace_month(contract.conform(raw, month, path.rpartition("/")[2]), month)
    return lake.table("bronze").read(months=[month]).count()


def run_silver(lake: Lake, month: Month) -> dict[str, int]:
    """Accepted and rejected trips and the rule counts of a month, from one evaluation kept on the executors' disks."""
    from pyspark import StorageLevel

    zones = lake.zones().withColumns({"first_loaded": F.lit(None).cast("date")})
    evaluated = layers.with_zone_names(rules.evaluate(lake.month("bronze", month)), zones).persist(StorageLevel.DISK_ONLY)
    try:
        lake.table("silver").replace_month(layers.silver(evaluated), month)
        lake.table("quarantine").replace_month(layers.quarantine(evaluated), month)
        lake.table("rule_counts").replace_month(rules.counts(evaluated), month)
    finally:
        evaluated.unpersist()
    counts = lake.table("rule_counts").read(months=[month])
    return {r["rule_id"]: r["matched_rows"] for r in counts.collect()} | {"rows": counts.agg(F.max("total_rows")).first()[0]}


def run_gold(lake: Lake, month: Month) -> list[tuple[str, int]]:
    """The three aggregates of a month; the ten companies with most trips."""
    silver, companies = lake.month("silver", month), lake.companies()
    lake.table("daily_company_trips").replace_month(layers.daily_company_trips(silver, companies), month)
    lake.table("hourly_pickup_zones").replace_month(layers.hourly_pickup_zones(silver), month)
    lake.table("monthly_driver_economics").replace_month(layers.monthly_driver_economics(silver, companies), month)
    rows = lake.table("monthly_driver_economics").read(months=[month]).orderBy(F.desc("trips"), "company").limit(10)
    return [(r["company"], r["trips"]) for r in rows.collect()]


def run_star(lake: Lake, month: Month) -> DataFrame:
    """Dimensions first, then facts, then the hourly aggregate from the facts as written; the checks of it all."""
    star.check_calendar(month, lake.calendar)
    silver = lake.month("silver", month)
    lake.table("dim_date").replace(star.dim_date(lake.spark, lake.calendar))
    lake.table("dim_time").replace(star.dim_time(lake.spark))
    lake.table("dim_zone").replace(lake.zones())
    lake.table("dim_company").upsert(star.dim_company(lake.companies().select("hvfhs_license_num", "company_name"), silver), ["hvfhs_license_num"])
    lake.table("fct_trips").replace_month(star.fct_trips(silver), month)
    facts = lake.table("fct_trips").read(months=[month])
    lake.table("fct_trips_hourly").replace_month(star.fct_trips_hourly(facts), month)
    zone = (lake.table("dim_zone").read(), "zone_key")
    found = {
        "date_key": (lake.table("dim_date").read(), "date_key"), "time_key": (lake.table("dim_time").read(), "time_key"),
        "pickup_zone_key": zone, "dropoff_zone_key": zone, "company_key": (lake.table("dim_company").read(), "company_key")
    }
    return star.checks(silver.count(), facts, lake.table("fct_trips_hourly").read(months=[month]), found)


def run_snapshot(lake: Lake, month: Month, folder: str) -> dict[str, int]:
    """The served tables of a month as plain Parquet; the rows found in each."""
    summary = quality.monthly_summary(
        lake.month("rule_counts", month), lake.table("quarantine").read(months=[month])
    ).select("data_month", "rows_checked", "rows_quarantined")
    frames = {n: lake.month(n, month) for n in SERVED[:3]} | {"rule_counts": lake.month("rule_counts", month), "quality_months": summary}
    return {n: export.write_snapshot(f, month, folder, n) for n, f in frames.items()}


def run_export(lake: Lake, folder: str) -> list[export.Exported]:
    names = ("dim_date", "dim_time", "dim_zone", "dim_company", "fct_trips", "fct_trips_hourly")
    return [export.write_single(f, folder, n) for n, f in export.star_frames({n: lake.table(n).read() for n in names}).items()]


def run_profile(lake: Lake, month: Month) -> str:
    raw = lake.spark.read.parquet(lake.raw_file(month)).withColumn("data_month", F.lit(month.first))
    return profiling.report(f"{lake.dataset} {month}", profiling.columns(raw))
