"""Measures over the star: columns to aggregate, and the joins and periods they need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.exact import amount, hundredths, ratio
from tripmart.layers import bounded_broadcast


def _cents(name: str) -> Column:
    return F.sum(hundredths(F.col(name)))


def trips() -> Column:
    return F.sum("trips")


def revenue() -> Column:
    return amount(_cents("total_fare_sum"))


def driver_pay() -> Column:
    return amount(_cents("driver_pay_sum"))


def average_fare() -> Column:
    return ratio(_cents("total_fare_sum"), F.sum("trips") * 100, 4)


def average_wait_minutes() -> Column:
    return ratio(F.sum("wait_time_seconds_sum"), F.sum("wait_time_trips") * 60, 4)


def driver_pay_share() -> Column:
    return ratio(_cents("driver_pay_sum"), _cents("total_fare_sum"), 4)


def trips_where(condition: Column) -> Column:
    """Trips under a filter of its own; null where nothing passes it."""
    return F.sum(F.when(condition, F.col("trips")))


def airport_pickups() -> Column:
    return trips_where(F.col("is_airport"))


def weekday_peak_share() -> Column:
    return ratio(trips_where(F.col("is_peak_hour") & ~F.col("is_weekend")), trips_where(~F.col("is_weekend")), 4)


#: The measures of the overview: name and aggregate.
OVERVIEW = {
    "total_trips": trips, "total_revenue": revenue, "avg_fare": average_fare, "avg_wait_minutes": average_wait_minutes,
    "driver_pay": driver_pay, "driver_pay_share": driver_pay_share, "airport_pickups": airport_pickups
}


def star(
    facts: DataFrame, *, date: DataFrame | None = None, time: DataFrame | None = None, zone: DataFrame | None = None,
    company: DataFrame | None = None, zone_role: str = "zone_key"
) -> DataFrame:
    """Facts with the dimensions asked for; facts without a dimension row keep null attributes.

    ``zone_role`` names the fact's key that meets the zone, so drop-offs can be read by zone as well.
    """
    for dimension, key, role in (
        (date, "date_key", "date_key"), (time, "time_key", "time_key"), (zone, "zone_key", zone_role),
        (company, "company_key", "company_key")
    ):
        if dimension is not None:
            attributes = [c for c in dimension.columns if c != key and c not in facts.columns]
            side = bounded_broadcast(dimension.select(F.col(key).alias("__key"), *attributes), 1_000_000)
            facts = facts.join(side, facts[role] == side["__key"], "left").drop("__key")
    return facts


def by(rows: DataFrame, groups: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    return rows.groupBy(*groups).agg(*[m.alias(n) for n, m in measures.items()])


def with_previous_month(monthly: DataFrame, groups: Sequence[str] = (), month: str = "month_start", value: str = "total_trips") -> DataFrame:
    """The same measure in the previous calendar month, null where that month has none, and the growth since."""
    before = monthly.select(*groups, F.add_months(F.col(month), 1).alias(month), F.col(value).alias("trips_previous_month"))
    joined = monthly.join(before, [*groups, month], "left")
    return joined.withColumn("trip_growth", F.round(F.try_divide(F.col(value) - F.col("trips_previous_month"), F.col("trips_previous_month")), 6))


def share_of_all(rows: DataFrame, value: str, rest: Sequence[str] = ()) -> DataFrame:
    """Each row's share of the sum over all rows that agree in the remaining groups."""
    return rows.withColumn("share", ratio(hundredths(F.col(value)), F.sum(hundredths(F.col(value))).over(Window.partitionBy(*rest)), 4))
