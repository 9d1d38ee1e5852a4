"""Files for other tools: snapshots partitioned by month, and single files of BI tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import storage
from tripmart.month import Month

MONTH = "data_month"


def write_snapshot(df: DataFrame, month: Month, root: str, name: str) -> int:
    """Write one month of a served table into its folder, also an empty one, and count what is there then.

    The month's folder is overwritten by its path: a dynamic partition overwrite would leave the old rows of a
    month that has become empty.
    """
    target = f"{root}/{name}/{MONTH}={month.first}"
    df.where(F.col(MONTH) == F.lit(month.first)).drop(MONTH).write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target).count()


def views(spark: SparkSession, root: str, names: list[str]) -> None:
    """Register the snapshot's tables as views; a missing one stops."""
    for n in names:
        if not storage.exists(spark, f"{root}/{n}"):
            raise FileNotFoundError(f"the snapshot {root} has no table {n}")
        spark.read.parquet(f"{root}/{n}").createOrReplaceTempView(n)


@dataclass(frozen=True)
class Exported:
    name: str
    rows: int
    size: int


def write_single(df: DataFrame, folder: str, name: str) -> Exported:
    """One Parquet file ``<name>.parquet``, put in place at once; other files of the folder stay."""
    spark = df.sparkSession
    staging, target = f"{folder}/.{name}-{uuid.uuid4().hex}", f"{folder}/{name}.parquet"
    try:
        df.coalesce(1).write.parquet(staging)  # one file is what is asked for
        parts = [n for n in storage.names(spark, staging) if n.startswith("part-") and n.endswith(".parquet")]
        if len(parts) != 1:
            raise RuntimeError(f"{len(parts)} files were written for {name}")
        storage.move(spark, f"{staging}/{parts[0]}", target)
    finally:
        storage.remove(spark, staging)
    return Exported(name, spark.read.parquet(target).count(), storage.size(spark, target))


def star_frames(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star as BI tools read it: no trip keys, a calendar of the whole years that have facts."""
    years = tables["fct_trips_hourly"].agg(F.min(F.year(MONTH)).alias("first"), F.max(F.year(MONTH)).alias("last")).first()
    out = dict(tables)
    out["fct_trips"] = tables["fct_trips"].drop("trip_key")
    out["dim_date"] = tables["dim_date"].where(F.col("year").between(years["first"] or 0, years["last"] or 0))
    return out
