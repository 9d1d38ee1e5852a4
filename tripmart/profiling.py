"""The profile of a month in one scan, repeated rows, frequent flags, and the report in Markdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag")
ZONES = ("PULocationID", "DOLocationID")


def columns(rows: DataFrame, by: Sequence[str] = ("data_month",), accuracy: int = 10_000) -> DataFrame:
    """A row per group and column: nulls and, of numbers, range, negatives, zeros, approximate p50 and p99, zones out of range.

    Works on the columns there are; columns starting with an underscore and the groups are left out.
    """
    kinds = {n: t for n, t in rows.dtypes if n not in by and not n.startswith("_")}
    numbers = [n for n, t in kinds.items() if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(kinds):
        c = F.col(f"`{n}`")
        aggregates.append(F.count_if(c.isNull()).alias(f"nulls{i}"))
        if n in numbers:
            aggregates += [
                F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}"), F.count_if(c < 0).alias(f"neg{i}"),
                F.count_if(c == 0).alias(f"zero{i}"), F.percentile_approx(c.cast("double"), [0.5, 0.99], accuracy).alias(f"p{i}")
            ]
        if n in ZONES:
            aggregates.append(F.count_if(~c.between(1, 265)).alias(f"out{i}"))
    wide = rows.groupBy(*by).agg(*aggregates)
    null = lambda t: F.lit(None).cast(t)
    entries = [
        F.struct(
            F.lit(n).alias("column_name"), F.col(f"nulls{i}").alias("nulls"), *(
                [
                    F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"), F.col(f"p{i}")[0].alias("p50"),
                    F.col(f"p{i}")[1].alias("p99"), F.col(f"neg{i}").alias("negative_rows"), F.col(f"zero{i}").alias("zero_rows")
                ] if n in numbers else [
                    null("double").alias(x) for x in ("min_value", "max_value", "p50", "p99")
                ] + [null("bigint").alias(x) for x in ("negative_rows", "zero_rows")]
            ),
            (F.col(f"out{i}") if n in ZONES else null("bigint")).alias("zones_out_of_range"),
        )
        for i, n in enumerate(kinds)
    ]
    return wide.select(*by, F.col("rows").alias("row_count"), F.inline(F.array(*entries)))


def duplicates(rows: DataFrame, keys: Sequence[str], by: Sequence[str] = ("data_month",)) -> DataFrame:
    """Groups of rows alike in ``keys``, the rows in them, and those beyond the first. Nulls are alike.

    Keys travel as two independent hashes, 16 bytes a row however wide they are.
    """
    shown = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x1e")) for k in keys])
    groups = rows.groupBy(*by, F.xxhash64(shown).alias("__a"), F.xxhash64(F.lit(1), shown).alias("__b")).agg(F.count(F.lit(1)).alias("n"))
    twice = F.col("n") > 1
    return groups.groupBy(*by).agg(
        F.count_if(twice).alias("groups"), F.coalesce(F.sum(F.when(twice, F.col("n"))), F.lit(0).cast("bigint")).alias("rows"),
        F.coalesce(F.sum(F.when(twice, F.col("n") - 1)), F.lit(0).cast("bigint")).alias("extra_rows")
    )


def frequent_flags(rows: DataFrame, flags: Sequence[str] = FLAGS, by: Sequence[str] = ("data_month",), most: int = 10) -> DataFrame:
    """The ``most`` frequent values of each flag per group, ties by value; all flags in one scan."""
    long = rows.select(*by, F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("value")) for f in flags])))
    counted = long.groupBy(*by, "flag", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(*by, "flag").orderBy(F.desc("n"), F.asc_nulls_first("value")))
    return counted.withColumn("place", place).where(F.col("place") <= most)


def timestamps(rows: DataFrame, by: Sequence[str] = ("data_month",)) -> DataFrame:
    """Rows whose times contradict each other or their month."""
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    outside = (F.to_date(p) < F.col("data_month")) | (F.to_date(p) >= F.add_months("data_month", 1))
    return rows.groupBy(*by).agg(
        F.count_if(outside).alias("pickup_outside_month"), F.count_if(d <= p).alias("dropoff_not_after_pickup"),
        F.count_if(p < F.col("request_datetime")).alias("pickup_before_request"),
        F.count_if(F.col("on_scene_datetime") > p).alias("on_scene_after_pickup")
    )


def report(title: str, profile: DataFrame) -> str:
    """A profile of one group, of as many rows as it has columns, as a Markdown table."""
    shown = lambda v: "" if v is None else f"{v:,}"
    names = ["column_name", "nulls", "min_value", "p50", "p99", "max_value", "negative_rows", "zero_rows", "zones_out_of_range"]
    rows = profile.select("row_count", *names).collect()
    lines = [f"# {title}", "", f"Rows: {shown(rows[0]['row_count']) if rows else 0}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names)]
    return "\n".join(lines + ["| " + " | ".join(r[n] if n == "column_name" else shown(r[n]) for n in names) + " |" for r in rows]) + "\n"
