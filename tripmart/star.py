"""The star schema: calendar, hours, zones and companies around trips and their hourly aggregate, with its checks."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.contract import NAMES
from tripmart.functions.exact import amount, hundredths
from tripmart.layers import CHARGES, bounded_broadcast
from tripmart.month import Month
from tripmart.session import checkpoint

CALENDAR = (date(2024, 1, 1), date(2027, 12, 31))
#: First hours of the parts of a day, hours of heavy traffic, service zones that are airports.
DAY_PARTS = ((18, "Evening"), (12, "Afternoon"), (6, "Morning"), (0, "Night"))
PEAK = (7, 8, 9, 16, 17, 18, 19)
AIRPORTS = ("Airports", "EWR")
MEASURES = (
    "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "tips", "driver_pay"
)
MONEY = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tips", "driver_pay", "total_fare")


class CalendarError(ValueError):
    """A month lies outside the calendar."""


def check_calendar(month: Month, calendar: tuple[date, date] = CALENDAR) -> None:
    if month.first < calendar[0] or month.following.first > date.fromordinal(calendar[1].toordinal() + 1):
        raise CalendarError(f"{month} is outside the calendar {calendar[0]} to {calendar[1]}")


def dim_date(spark: SparkSession, calendar: tuple[date, date] = CALENDAR) -> DataFrame:
    if calendar[1] < calendar[0]:
        raise CalendarError("the calendar ends before it begins")
    d = F.date_add(F.lit(calendar[0]), F.col("id").cast("int"))
    days = spark.range((calendar[1] - calendar[0]).days + 1).select(d.alias("date"))
    c = F.col("date")
    return days.select(
        date_key(c).alias("date_key"), "date", F.year(c).alias("year"), F.quarter(c).alias("quarter"), F.month(c).alias("month"), F.date_format(c, "MMMM").alias("month_name"), F.trunc(c, "month").alias("month_start"),
        F.dayofmonth(c).alias("day_of_month"), (F.weekday(c) + 1).alias("day_of_week"), F.date_format(c, "EEEE").alias("day_name"), (F.weekday(c) >= 5).alias("is_weekend"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    part = F.coalesce(*[F.when(h >= first, F.lit(name)) for first, name in DAY_PARTS])
    return spark.range(24).select(
        h.alias("time_key"), h.alias("hour"), F.format_string("%02d:00", h).alias("hour_label"), part.alias("day_part"),
        h.isin(*PEAK).alias("is_peak_hour")
    )


def dim_zone(lookup: DataFrame) -> DataFrame:
    """The zone dimension from a lookup of texts: LocationID, Borough, Zone, service_zone."""
    zone = F.col("LocationID").cast("int")
    return lookup.select(
        zone.alias("zone_key"), zone.alias("location_id"), F.col("Borough").alias("borough"), F.col("Zone").alias("zone"), "service_zone",
        F.coalesce(F.col("service_zone").isin(*AIRPORTS), F.lit(False)).alias("is_airport")
    )


def dim_company(known: DataFrame, accepted: DataFrame) -> DataFrame:
    """Known companies and all licences seen; names are those known, ``Other (code)`` else; never a null licence."""
    seen = accepted.select("hvfhs_license_num").distinct().withColumn("company_name", F.concat(F.lit("Other ("), F.col("hvfhs_license_num"), F.lit(")")))
    rows = known.select("hvfhs_license_num", "company_name", F.lit(0).alias("order")).unionByName(seen.withColumn("order", F.lit(1)))
    named = rows.where("hvfhs_license_num IS NOT NULL").groupBy("hvfhs_license_num").agg(
        F.min_by("company_name", F.struct("order", "company_name")).alias("company_name")
    )
    return named.select(company_key(F.col("hvfhs_license_num")).alias("company_key"), "hvfhs_license_num", "company_name")


def date_key(day: Column) -> Column:
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def company_key(licence: Column) -> Column:
    return F.xxhash64(licence)


def wait_seconds(request: Column, pickup: Column) -> Column:
    """Whole seconds from request to pickup; null where one is missing or the pickup comes first."""
    waited = F.timestamp_diff("SECOND", request, pickup)
    return F.when(waited >= 0, waited)


def _row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns], F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns]))


def with_trip_key(trips: DataFrame, columns: Sequence[str] = NAMES, *, among: DataFrame | None = None) -> DataFrame:
    """``trip_key``: a hash of all source columns, of which are null, and of a number among identical rows.

    Rows are only shuffled where their hash occurs more than once: hashes alone are counted first, in ``among``, a
    frame that holds all the trips and is cheaper to read, if there is one.
    """
    counted = (trips if among is None else among).select(_row_hash(columns).alias("__several"))
    several = bounded_broadcast(checkpoint(counted.groupBy("__several").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__several")), 100_000)
    hashed = trips.withColumn("__hash", _row_hash(columns))
    met = hashed.join(several, hashed["__hash"] == several["__several"], "left")
    alone = met.where("__several IS NULL").withColumn("__number", F.lit(1))
    again = met.where("__several IS NOT NULL").withColumn("__number", F.row_number().over(Window.partitionBy("__hash", *columns).orderBy("__hash")))
    both = alone.unionByName(again)
    return both.withColumn("trip_key", F.xxhash64("__hash", "__number")).drop("__hash", "__several", "__number")


def fct_rows(accepted: DataFrame) -> DataFrame:
    """The facts of accepted trips with their trip keys where they have them; aggregates need none."""
    fare = amount(
        sum(
            (F.coalesce(hundredths(F.col(c)), F.lit(0).cast("bigint")) for c in CHARGES[1:]),
            F.coalesce(hundredths(F.col(CHARGES[0])), F.lit(0).cast("bigint"))
        )
    )
    pickup = F.col("pickup_datetime")
    key = ["trip_key"] if "trip_key" in accepted.columns else []
    return accepted.select(
        *key, date_key(F.to_date(pickup)).alias("date_key"), F.hour(pickup).alias("time_key"), F.col("PULocationID").alias("pickup_zone_key"), F.col("DOLocationID").alias("dropoff_zone_key"), company_key(F.col("hvfhs_license_num")).alias("company_key"),
        *MEASURES, fare.alias("total_fare"), wait_seconds(F.col("request_datetime"), pickup).alias("wait_time_seconds"), "data_month",
    )


def fct_trips(accepted: DataFrame, *, among: DataFrame | None = None) -> DataFrame:
    return fct_rows(with_trip_key(accepted, among=among))


def fct_trips_hourly(facts: DataFrame) -> DataFrame:
    """Facts per day, hour, pickup zone and company; a sum of nothing but nulls stays null."""
    return facts.groupBy("date_key", "time_key", F.col("pickup_zone_key").alias("zone_key"), "company_key", "data_month").agg(
        F.count(F.lit(1)).alias("trips"), amount(F.sum(hundredths(F.col("trip_miles")))).alias("trip_miles_sum"), F.sum("trip_time").alias("trip_time_sum"),
        *[
            amount(F.sum(hundredths(F.col(c)))).alias(f"{c}_sum") for c in MONEY
        ], F.sum("wait_time_seconds").alias("wait_time_seconds_sum"), F.count("wait_time_seconds").alias("wait_time_trips"),
    )


def orphan_counts(facts: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``key, orphans``: facts whose key has no dimension row, null keys too. All keys in one scan."""
    met = facts
    for key, (dimension, column) in dimensions.items():
        side = bounded_broadcast(dimension.select(F.col(column).alias(f"__{key}")).where(F.col(f"__{key}").isNotNull()).distinct(), 1_000_000)
        met = met.join(side, met[key] == side[f"__{key}"], "left")
    wide = met.agg(*[F.count_if(F.col(f"__{k}").isNull()).alias(k) for k in dimensions])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("orphans")) for k in dimensions])))


def checks(silver_rows: int, facts: DataFrame, hourly: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``name, expected, actual, passed`` of every check of the star as written: eight with the five keys."""
    spark = facts.sparkSession
    # three questions to the tables as written, asked side by side
    with ThreadPoolExecutor(3) as pool:
        keys = pool.submit(facts.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("trip_key").alias("keys")).first)
        sums = pool.submit(hourly.agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("trips")).first)
        lost = pool.submit(lambda: orphan_counts(facts, dimensions).collect())
        f, h, orphans = keys.result(), sums.result(), lost.result()
    rows = [
        ("accepted trips are facts", silver_rows, f["rows"]), ("trip keys are unique", f["rows"], f["keys"]),
        ("hourly trips add up to facts", f["rows"], h["trips"])
    ]
    rows += [(f"{r['key']} finds its dimension row", 0, r["orphans"]) for r in orphans]
    return spark.createDataFrame([(n, int(e), int(a), int(e) == int(a)) for n, e, a in rows], "name string, expected bigint, actual bigint, passed boolean")
