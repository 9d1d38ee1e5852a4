"""From conformed trips to accepted and rejected ones, and the aggregates over the accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contract import NAMES
from tripmart.functions.exact import amount, hundredths, ratio, total

#: What a passenger pays for a trip.
CHARGES = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tips")
ZONE_NAMES = ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def bounded_broadcast(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else left to a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def zone_lookup(zones: DataFrame) -> DataFrame:
    """One row per zone id, the one loaded last, so that a join can't multiply trips."""
    return zones.where("location_id IS NOT NULL").groupBy("location_id").agg(
        F.max_by(F.struct("borough", "zone", "service_zone"), F.struct("first_loaded", "zone_key")).alias("z")
    ).select("location_id", "z.*")


def with_zone_names(trips: DataFrame, zones: DataFrame, *, most_zones: int = 100_000) -> DataFrame:
    """The names of the pickup and the drop-off zone; unknown zones give null names."""
    z = bounded_broadcast(zone_lookup(zones), most_zones)
    for column, role in (("PULocationID", "pickup"), ("DOLocationID", "dropoff")):
        side = z.select(F.col("location_id").alias("__id"), F.col("borough").alias(f"{role}_borough"), F.col("zone").alias(f"{role}_zone"))
        trips = trips.join(side, trips[column] == side["__id"], "left").drop("__id")
    return trips


def silver(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.size("failed_rules") == 0).select(*NAMES, *ZONE_NAMES, "quality_warnings", "_source_file", "data_month")


def quarantine(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.size("failed_rules") > 0).select(*NAMES, "failed_rules", "quality_warnings", "_source_file", "data_month")


def company_names(companies: DataFrame) -> DataFrame:
    return companies.where("hvfhs_license_num IS NOT NULL").groupBy(F.col("hvfhs_license_num").alias("__licence")).agg(
        F.max_by("company_name", "first_loaded").alias("__name")
    )


def company(name: Column, licence: Column) -> Column:
    return F.when(licence.isNull(), F.lit("Unknown")).otherwise(F.coalesce(name, F.concat(F.lit("Other ("), licence, F.lit(")"))))


def with_company(rows: DataFrame, companies: DataFrame, *, most_companies: int = 100_000) -> DataFrame:
    """``company``: the name of the licence, ``Other (code)`` for an unknown one, ``Unknown`` for none."""
    names = bounded_broadcast(company_names(companies), most_companies)
    return rows.join(names, rows["hvfhs_license_num"] == names["__licence"], "left").withColumn(
        "company", company(F.col("__name"), F.col("hvfhs_license_num"))
    ).drop("__licence", "__name")


def daily_company_trips(accepted: DataFrame, companies: DataFrame) -> DataFrame:
    """Trips and totals per day and licence. Names are joined after aggregation, to a few rows."""
    paid = amount(
        F.sum(
            sum(
                (F.coalesce(hundredths(F.col(c)), F.lit(0).cast("bigint")) for c in CHARGES[1:]),
                F.coalesce(hundredths(F.col(CHARGES[0])), F.lit(0).cast("bigint"))
            )
        )
    )
    rows = accepted.groupBy("data_month", F.to_date("pickup_datetime").alias("trip_date"), "hvfhs_license_num").agg(
        F.count(F.lit(1)).alias("trips"), total("base_passenger_fare").alias("base_fare_total"), total("tips").alias("tips_total"), total("driver_pay").alias("driver_pay_total"), paid.alias("passenger_paid_total"),
        ratio(
            F.sum(hundredths(F.col("trip_miles"))), F.count("trip_miles") * 100, 3
        ).alias("avg_trip_miles"), ratio(F.sum("trip_time"), F.count("trip_time") * 60, 2).alias("avg_trip_minutes"),
    )
    return with_company(rows, companies)


def hourly_pickup_zones(accepted: DataFrame) -> DataFrame:
    keys = [
        "data_month", F.to_date("pickup_datetime").alias("pickup_date"), F.hour("pickup_datetime").alias("pickup_hour"), "PULocationID",
        "pickup_borough", "pickup_zone"
    ]
    return accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


def monthly_driver_economics(accepted: DataFrame, companies: DataFrame) -> DataFrame:
    """Totals per month and licence; ratios are those of the unrounded totals, null without a positive denominator."""
    sums = accepted.groupBy("data_month", "hvfhs_license_num").agg(
        F.count(F.lit(1)).alias("trips"), F.sum(hundredths(F.col("driver_pay"))).alias("pay"), F.sum(hundredths(F.col("trip_miles"))).alias("miles"),
        F.sum("trip_time").alias("seconds"), F.sum(hundredths(F.col("base_passenger_fare"))).alias("fare"),
    )
    rows = sums.select(
        "data_month", "hvfhs_license_num", "trips", amount(F.col("pay")).alias("driver_pay_total"), amount(F.col("miles")).alias("trip_miles_total"), ratio(
            F.col("seconds"), F.when(F.col("seconds").isNotNull(), F.lit(60)), 2
        ).alias("trip_minutes_total"),
        ratio(F.col("pay"), F.col("miles"), 4).alias("driver_pay_per_mile"), ratio(
            F.col("pay") * 60, F.col("seconds") * 100, 4
        ).alias("driver_pay_per_minute"), ratio(F.col("pay"), F.col("fare"), 4).alias("driver_share_of_base_fare"),
    )
    return with_company(rows, companies)
