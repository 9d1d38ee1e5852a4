"""Answers over the served tables: validated arguments, sorted rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import quality
from tripmart.month import Month

MOST_DAYS = 92


class BadRequest(ValueError):
    """Arguments that can't be answered (status 422)."""


class NotServed(LookupError):
    """A month that isn't there (status 404); the message lists those that are."""


def months(economics: DataFrame) -> list[date]:
    return [r[0] for r in economics.select("data_month").distinct().orderBy("data_month").collect()]


def _month(text: str, economics: DataFrame) -> date:
    try:
        month = Month.parse(text).first
    except ValueError as wrong:
        raise BadRequest(str(wrong)) from wrong
    there = months(economics)
    if month not in there:
        raise NotServed(f"{text} is not served; served are {', '.join(str(Month.of(m)) for m in there)}")
    return month


def driver_economics(economics: DataFrame, month: str, company: str | None = None) -> DataFrame:
    rows = economics.where(F.col("data_month") == F.lit(_month(month, economics)))
    if company is not None:
        rows = rows.where(F.col("company") == company)
    return rows.drop("hvfhs_license_num").orderBy(F.desc("trips"), "company")


def daily_trips(daily: DataFrame, start: date, end: date, company: str | None = None) -> DataFrame:
    if end < start:
        raise BadRequest("the period ends before it starts")
    if (end - start).days >= MOST_DAYS:
        raise BadRequest(f"a period has at most {MOST_DAYS} days")
    rows = daily.where(F.col("trip_date").between(F.lit(start), F.lit(end)))
    if company is not None:
        rows = rows.where(F.col("company") == company)
    return rows.drop("data_month", "hvfhs_license_num").orderBy("trip_date", "company")


def busiest_zones(hourly: DataFrame, economics: DataFrame, month: str, hour: int | None = None, limit: int = 10) -> DataFrame:
    """The ``limit`` zones with most pickups of a month or of one hour of its days, ties by zone id."""
    if hour is not None and not 0 <= hour <= 23:
        raise BadRequest("an hour is 0 to 23")
    if not 1 <= limit <= 50:
        raise BadRequest("a limit is 1 to 50")
    rows = hourly.where(F.col("data_month") == F.lit(_month(month, economics)))
    if hour is not None:
        rows = rows.where(F.col("pickup_hour") == hour)
    zones = rows.groupBy(
        F.col("PULocationID").alias("zone_id"), F.col("pickup_borough").alias("borough"), F.col("pickup_zone").alias("zone")
    ).agg(F.sum("trips").alias("trips"))
    return zones.orderBy(F.desc("trips"), "zone_id").limit(limit)


def monthly_quality(summary: DataFrame, rule_counts: DataFrame) -> DataFrame:
    spiking = quality.spike_rules(quality.rule_rates(rule_counts))
    rows = summary.select("data_month", "rows_checked", "rows_quarantined", "quarantine_rate").join(spiking, "data_month", "left")
    return rows.withColumn("spike_rules", F.coalesce("spike_rules", F.array().cast("array<string>"))).orderBy("data_month")
