"""Percentiles of very large numeric columns by radix selection.

A double is mapped to a 64-bit integer of the same order, which is read in digits of 12 bits (the last has 4). The
first pass counts the first digit per group; each further pass looks only at values whose digits so far are those of a
bin that holds a target rank, and counts their next digit. A bin of one value is done; a bin of at most
``gather`` values is done by bringing those values together, so no task ever holds more of a group than that.

The percentile p of n values is the value of rank ``max(1, ceil(p * n))``; p is given in basis points, so ranks
are exact integers and the results exact. Nulls and NaN are left out; a group without values gives no row; ties and
repeated rows count as often as they occur; groups with null keys are groups. Partial counts are made before each
shuffle, of at most 4,096 bins a group and pass. The open bins of all groups are one row a group: they are broadcast
up to ``broadcast_groups`` groups, beyond that joined by shuffle, where adaptive execution splits hot groups.

For results that combine, ``histogram`` keeps the first 24 bits: histograms of single loads, files or days
add up to that of their union (``merge``), and a percentile read from it has a relative error under ``2 ** -12``
(11 bits of exponent and 12 of the fraction lie in it) and comes with the interval that holds the exact value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.columns import leading_bits, order_bits
from tripmart.session import checkpoint

#: Bits below each digit.
SHIFTS = (52, 40, 28, 16, 4, 0)
SUMMARY_BITS = 24
RELATIVE_ERROR = 2.0**-12


def _value(c: Column) -> Column:
    """A number as double; null where it is none. -0.0 is 0.0."""
    v = c.cast("double")
    return F.when(~F.isnan(v), v + F.lit(0.0))


def measures(df: DataFrame, groups: dict[str, Column], fields: dict[str, Column]) -> DataFrame:
    """One row for each value: the groups, ``field`` and ``value``."""
    entries = F.array(*[F.struct(F.lit(n).alias("field"), _value(c).alias("value")) for n, c in fields.items()])
    return df.select(*[c.alias(n) for n, c in groups.items()], F.inline(entries)).where(F.col("value").isNotNull())


def _counted(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def histogram(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The mergeable state: ``n``, ``low``, ``high`` for each (groups, field, ``bin``)."""
    return _counted(rows.withColumn("bin", leading_bits(F.col("value"), SUMMARY_BITS)), [*groups, "field", "bin"])


def merge(histograms: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Add up histograms of several loads into those of coarser groups."""
    return histograms.groupBy(*groups, "field", "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _rank(points: Column, n: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.expr("0L") + F.floor((points * n + F.lit(9999)) / F.lit(10000)).cast("bigint"))


def select_bins(hist: DataFrame, by: Sequence[str], points: Sequence[int]) -> DataFrame:
    """For each group and percentile the bin with the target rank, and the rank inside it."""
    ordered = Window.partitionBy(*by).orderBy("bin")
    cumulated = hist.withColumn("upto", F.sum("n").over(ordered)).withColumn("group_rows", F.sum("n").over(Window.partitionBy(*by)))
    wanted = F.array(*[F.struct(F.lit(p).alias("basis_points"), _rank(F.lit(p).cast("bigint"), F.col("group_rows")).alias("rank")) for p in points])
    inside = F.filter(wanted, lambda w: (w["rank"] <= F.col("upto")) & (w["rank"] > F.col("upto") - F.col("n")))
    return cumulated.where(F.size(inside) > 0).select(
        *by, "bin", "n", "low", "high", "group_rows", "upto", F.inline(inside)
    ).withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n"))).drop("upto")


def _inside(wide: DataFrame, chosen: DataFrame, names: Sequence[str], fields: Sequence[str], level: int, broadcast_groups: int) -> DataFrame:
    """``__group, field, bin, value, bits`` of the values in the chosen bins of ``level``; groups by number."""
    bins = [F.collect_set(F.when(F.col("field") == f, F.col("bin"))).alias(f"__bins{i}") for i, f in enumerate(fields)]
    state = chosen.groupBy(*[F.col(f"`{n}`").alias(f"__k{i}") for i, n in enumerate(names)], F.col("__group")).agg(*bins)
    if state.count() <= broadcast_groups:
        state = F.broadcast(state)
    same = [wide[n].eqNullSafe(state[f"__k{i}"]) for i, n in enumerate(names)]
    met = wide.join(state, same) if same else wide.crossJoin(state)  # without groups the state is one row
    shifted = lambda i: F.shiftright(f"__bits{i}", SHIFTS[level])
    entries = F.array(
        *[
            F.when(
                F.array_contains(f"__bins{i}", shifted(i)),
                F.struct(F.lit(f).alias("field"), shifted(i).alias("bin"), F.col(f"__value{i}").alias("value"), F.col(f"__bits{i}").alias("bits"))
            ) for i, f in enumerate(fields)
        ]
    )
    return met.select("__group", F.inline(entries)).where(F.col("field").isNotNull())


def percentiles(
    df: DataFrame, groups: dict[str, Column], fields: dict[str, Column], points: Sequence[int], *, gather: int = 32_768,
    broadcast_groups: int = 500_000
) -> DataFrame:
    """Exact percentiles: groups, ``field``, ``basis_points``, ``value``, ``group_rows``."""
    names, places = list(groups), list(enumerate(fields.values()))
    out = [*names, "field", "basis_points", "value", "group_rows"]
    wide = df.select(*[c.alias(n) for n, c in groups.items()], *[_value(c).alias(f"__value{i}") for i, c in places])
    wide = wide.withColumns({f"__bits{i}": order_bits(F.col(f"__value{i}")) for i, _ in places})
    first = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.shiftright(f"__bits{i}", SHIFTS[0]).alias("bin"), F.col(f"__value{i}").alias("value")
            ) for i, f in enumerate(fields)
        ]
    )
    by = [*names, "field"]
    hist = _counted(wide.select(*names, F.inline(first)).where(F.col("value").isNotNull()), [*by, "bin"])
    # a row for each group, field and percentile; groups get a number, so that later shuffles needn't carry their keys
    group = F.xxhash64(*[F.col(f"`{n}`") for n in names], *[F.col(f"`{n}`").isNull() for n in names]) if names else F.lit(0).cast("bigint")
    chosen = checkpoint(select_bins(hist, by, points).withColumn("__group", group))
    done, level = [], 0
    while True:
        done.append(chosen.where("low = high").withColumn("value", F.col("low")).select(*out))
        open_ = chosen.where("low < high")
        small, large = open_.where(F.col("n") <= gather), open_.where(F.col("n") > gather)
        if not small.isEmpty():
            values = _inside(
                wide, small, names, list(fields), level, broadcast_groups
            ).groupBy("__group", "field", "bin").agg(F.collect_list("value").alias("values"))
            found = small.select(*names, "__group", "field", "bin", "basis_points", "rank", "group_rows").join(values, ["__group", "field", "bin"])
            done.append(checkpoint(found.withColumn("value", F.sort_array("values")[(F.col("rank") - 1).cast("int")]).select(*out)))
        if large.isEmpty():
            break
        level += 1
        kept = _inside(
            wide, large, names, list(fields), level - 1, broadcast_groups
        ).withColumnRenamed("bin", "__above").withColumn("bin", F.shiftright("bits", SHIFTS[level]))
        inner = ["__group", "field", "__above"]
        cumulated = _counted(kept, [*inner, "bin"]).withColumn("upto", F.sum("n").over(Window.partitionBy(*inner).orderBy("bin")))
        ranks = large.select(*names, "__group", "field", F.col("bin").alias("__above"), "basis_points", "rank", "group_rows")
        met = cumulated.join(ranks, inner).where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        chosen = checkpoint(
            met.withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n"))).select(
                *by, "__group", "bin", "n", "low", "high", "basis_points", "rank", "group_rows"
            )
        )
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def bounded_percentiles(hist: DataFrame, groups: Sequence[str], points: Sequence[int]) -> DataFrame:
    """Percentiles from histograms alone, with the interval that holds the exact value.

    ``value`` is the middle of [``low``, ``high``]; it is within ``RELATIVE_ERROR`` of the exact one.
    """
    middle = F.col("low") + (F.col("high") - F.col("low")) / 2
    return select_bins(hist, [*groups, "field"], points).select(*groups, "field", "basis_points", middle.alias("value"), "low", "high", F.col("group_rows"))
