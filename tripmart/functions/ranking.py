"""Numbering rows in a global order without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import checkpoint, shuffle_partitions


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with each row's place in the order, from 1.

    A range shuffle cuts the order into as many ranges as there are shuffle partitions, written once; the
    counts of the ranges before, one row each, are added to the place inside a range.
    """
    cut = checkpoint(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("__range", F.spark_partition_id()))
    sizes = cut.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__r", (F.sum("__n").over(Window.orderBy("__r")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return cut.withColumn("__place", place).join(
        F.broadcast(before), F.col("__range") == F.col("__r")
    ).withColumn(name, F.col("__place") + F.col("__before")).drop("__range", "__r", "__before", "__place")
