"""Column-level quality profile of loads from one shared scan and mergeable states.

Checks are declared as data (``Check``) and compiled into one aggregate: every column of a row falls into a bin, and a
load's state is the count, least and greatest value of each bin that occurs. A bin tells whether the value is null, as
declared or violating, which valid code it is, or the leading bits of a measure. All figures are read from the bins:
rows, nulls, violations, negatives, zeros, range, exact numbers of valid codes, and medians within one part in 2 ** 6,
exact where a bin holds one value. A load has at most 100,000 bins of codes a column and some hundred of a measure,
made before the shuffle. Counts, minima and maxima merge: states of partitions, loads or days add up (``merge_states``).

Findings compare a load with the previous one of its feed; a median whose bin leaves a finding open is read exactly, from
the values of that bin alone. ``control_limits`` holds each metric against the history of its feed. Every rate counts
rows as they are, repeated ones too. Nulls violate no pattern or range. Rows without a load are left out. A column
without values has null median and range and no distinct value; a feed's first load has nothing to be compared with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.columns import feed_of, leading_bits

#: Bits of a measure that tell its bin: sign, exponent and six of the fraction.
BIN_BITS = 18
NULL, VALID, VIOLATING = 0, 1, 2
NUMBERS = ("double", "float", "bigint", "int", "smallint", "tinyint")
STATES = ["source_file", "place", "kind", "bin"]


@dataclass(frozen=True)
class Check:
    """What is known of a column: a ``pattern`` for texts, the least and greatest value, whether its codes are counted or its median wanted."""

    column: str
    pattern: str | None = None
    least: float | None = None
    most: float | None = None
    distinct: bool = False
    median: bool = False

    def violates(self, number: Column, text: Column) -> Column:
        if self.pattern:
            return ~text.rlike(self.pattern)
        low = number < self.least if self.least is not None else F.lit(False)
        high = number > self.most if self.most is not None else F.lit(False)
        return low | high

    def bin(self, number: Column, text: Column, violating: Column, bits: Column) -> Column:
        """Below 0 a negative number, 0 zero; codes by their digits, measures by their leading ``bits``."""
        if self.pattern:
            return F.when(~violating, F.regexp_extract(text, r"(\d+)", 1).cast("int")) if self.distinct else F.lit(0)
        if self.distinct:
            return F.when(violating, F.signum(number).cast("int") * (2**30)).otherwise(number.cast("int"))
        if self.median:
            return bits + (number > 0).cast("int")
        return F.signum(F.when(~F.isnan(number), number)).cast("int")

    @property
    def kind(self) -> str | None:
        return "pattern" if self.pattern else "range" if self.least is not None or self.most is not None else None


def _by_rule(checks: Sequence[Check], expression: Callable[[Check], Column]) -> Column:
    """An expression of each check, once for all checks that differ in their column only."""
    rules: dict[Check, list[int]] = {}
    for i, k in enumerate(checks):
        rules.setdefault(replace(k, column=""), []).append(i)
    return F.coalesce(*[F.when(F.col("place").isin(places), expression(rule)) for rule, places in rules.items()], F.lit(None))


def _bits(checks: Sequence[Check]) -> list[Column]:
    """The leading bits of the measures, in a projection of their own, which computes each part of them once."""
    return [leading_bits(F.col(f"`{k.column}`"), BIN_BITS).alias(f"__bits{i}") for i, k in enumerate(checks) if k.median]


def column_states(rows: DataFrame, load: str, month: str, checks: Sequence[Check]) -> DataFrame:
    """``source_file, place, kind, bin, data_month, n, low, high``: the bins of every column of every load, from one scan."""
    types = dict(rows.dtypes)

    def entry(i: int, k: Check) -> Column:
        c, text, none = F.col(f"`{k.column}`"), F.lit(None).cast("string"), F.lit(None).cast("int")
        if types[k.column] in NUMBERS:
            bits = F.col(f"__bits{i}") if k.median else none
            return F.struct(F.lit(i).cast("tinyint").alias("place"), c.cast("double").alias("value"), text.alias("text"), bits.alias("bits"))
        return F.struct(
            F.lit(i).cast("tinyint").alias("place"), F.when(c.isNotNull(), F.lit(0.0)).alias("value"),
            (c if k.pattern else text).alias("text"), none.alias("bits")
        )

    # the values first, then what they are: written once a rule, the generated code stays small
    given = rows.where(F.col(load).isNotNull()).select(
        F.col(load).alias("source_file"), F.col(month).alias("data_month"), *_bits(checks), *[F.col(f"`{k.column}`") for k in checks]
    )
    long = given.select("source_file", "data_month", F.inline(F.array(*[entry(i, k) for i, k in enumerate(checks)])))
    number, text, violating = F.col("value"), F.col("text"), F.col("violating")
    long = long.withColumn("violating", F.coalesce(_by_rule(checks, lambda k: k.violates(number, text)), F.lit(False)))
    state = F.when(number.isNull(), NULL).when(violating, VIOLATING).otherwise(VALID).cast("tinyint")
    binned = long.select(
        "source_file", "data_month", "place", "value", state.alias("kind"),
        F.coalesce(_by_rule(checks, lambda k: k.bin(number, text, violating, F.col("bits"))), F.lit(0)).alias("bin")
    )
    return binned.groupBy(*STATES).agg(
        F.min("data_month").alias("data_month"), F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def merge_states(states: DataFrame, source_file: Column) -> DataFrame:
    """The states of coarser loads: those of all loads that ``source_file`` gives the same name."""
    named = states.withColumn("source_file", source_file)
    return named.groupBy(*STATES).agg(F.min("data_month").alias("data_month"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def profiles(states: DataFrame, checks: Sequence[Check], types: dict[str, str]) -> DataFrame:
    """One row per load and column; ``violations``, ``distinct_values``, ``median_value`` where declared.

    ``median_low`` and ``median_high`` hold the median, ``median_bin`` and ``median_rank`` tell where it is among the values.
    """
    place, kind, n = F.col("place"), F.col("kind"), F.col("n")
    of = lambda which: place.isin([i for i, k in enumerate(checks) if which(k)])
    number, declared, coded, middle = of(lambda k: types[k.column] in NUMBERS), of(lambda k: k.kind), of(lambda k: k.distinct), of(lambda k: k.median)
    # NaN is a value, but has no place in the order
    ordered = (kind != NULL) & ~F.isnan("high") & middle
    order = Window.partitionBy("source_file", "place").orderBy(ordered.desc(), "bin", "kind")
    walked = states.withColumns(
        {"upto": F.sum(F.when(ordered, n)).over(order), "all": F.sum(F.when(ordered, n)).over(Window.partitionBy("source_file", "place"))}
    )
    rank = F.floor((F.col("all") + 1) / 2)
    at = ordered & (F.col("upto") >= rank) & (F.col("upto") - n < rank)
    zero = F.lit(0).cast("bigint")
    counted = lambda which: F.coalesce(F.sum(F.when(which, n)), zero)
    found = walked.groupBy("source_file", "place").agg(
        F.min("data_month").alias("data_month"), F.sum("n").alias("row_count"), counted(kind == NULL).alias("nulls"), counted(kind == VIOLATING).alias("violations"),
        F.count_if(kind == VALID).alias("distinct_values"), F.min(F.when(number, F.col("low"))).alias("min_value"), F.max(F.when(number, F.col("high"))).alias("max_value"),
        counted((kind != NULL) & (F.col("bin") < 0)).alias("negative_rows"), counted((kind != NULL) & (F.col("bin") == 0)).alias("zero_rows"),
        F.max(F.when(at, F.struct("low", "high", "bin", (rank - F.col("upto") + n).alias("rank")))).alias("m"),
    )
    only = lambda name, which: F.when(which, F.col(name)).alias(name)
    names = F.array(*[F.lit(k.column) for k in checks])
    return found.select(
        "source_file", "data_month", names[place.cast("int")].alias("column_name"), "row_count", "nulls", only("violations", declared), only("distinct_values", coded), "min_value", "max_value",
        only("negative_rows", number), only("zero_rows", number), (
            (F.col("m.low") + F.col("m.high")) / 2
        ).alias("median_value"), F.col("m.low").alias("median_low"), F.col("m.high").alias("median_high"), F.col("m.bin").alias("median_bin"), F.col("m.rank").alias("median_rank"),
    )


def column_profiles(rows: DataFrame, load: str, month: str, checks: Sequence[Check]) -> DataFrame:
    return profiles(column_states(rows, load, month, checks), checks, dict(rows.dtypes))


def sketches(rows: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """Mergeable sketches of the distinct values of any columns (standard error 1.6 %), and their range as text in the order of the column's type."""
    out = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        out += [
            F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), 12).alias(f"s{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
            F.count_if(c.isNull()).alias(f"n{i}")
        ]
    states = rows.where(F.col(load).isNotNull()).groupBy(F.col(load).alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("data_month").alias("data_month"), *out
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col(f"s{i}").alias("sketch"),
            F.col(f"lo{i}").cast("string").alias("least"), F.col(f"hi{i}").cast("string").alias("greatest")
        ) for i, name in enumerate(columns)
    ]
    return states.select("source_file", "data_month", "row_count", F.inline(F.array(*entries)))


def with_previous(found: DataFrame) -> DataFrame:
    """Profiles with the figures of the feed's previous load, as ``previous_...``."""
    of_feed = Window.partitionBy("feed", "column_name").orderBy("data_month", "source_file")
    names = ["source_file", "row_count", "nulls", "distinct_values", "median_value", "median_low", "median_high"]
    return found.withColumn("feed", feed_of(F.col("source_file"))).withColumns({f"previous_{n}": F.lag(n).over(of_feed) for n in names})


def settled(found: DataFrame, rows: DataFrame, load: str, checks: Sequence[Check], *, median_ratio: float = 1.4) -> DataFrame:
    """``found`` with exact medians where those of a load and its previous one are so near ``median_ratio`` that their bins don't tell.

    Only the values of the bins in question are read again, if there are any. ``found`` should be stored.
    """
    p = with_previous(found)
    low, high, before_low, before_high = F.col("median_low"), F.col("median_high"), F.col("previous_median_low"), F.col("previous_median_high")
    sure = (low > before_high * median_ratio) | (before_low > high * median_ratio) | ((high <= before_low * median_ratio) & (before_high <= low * median_ratio))
    asked = p.where((low >= 0) & (before_low >= 0) & ~sure | (((low < 0) | (before_low < 0)) & ((low < high) | (before_low < before_high))))
    pairs = asked.select("column_name", F.explode(F.array("source_file", "previous_source_file")).alias("source_file")).distinct()
    open_ = found.where("median_low < median_high").join(pairs, ["source_file", "column_name"], "left_semi").select(
        "source_file", F.col("column_name").alias("__column"), "median_bin", "median_rank"
    )
    if open_.isEmpty():
        return found
    value = lambda k: F.col(f"`{k.column}`").cast("double")
    entries = F.array(
        *[
            F.struct(
                F.lit(k.column).alias("column"), k.bin(value(k), F.lit(""), F.lit(False), F.col(f"__bits{i}")).alias("bin"),
                value(k).alias("value")
            ) for i, k in enumerate(checks) if k.median
        ]
    )
    long = rows.select(load, *_bits(checks), *[F.col(f"`{k.column}`") for k in checks if k.median]).join(
        open_.select(F.col("source_file").alias("__load")).distinct(), F.col(load) == F.col("__load"), "left_semi"
    ).select(F.col(load).alias("source_file"), F.inline(entries)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = long.join(
        open_,
        (long["source_file"] == open_["source_file"]) & (F.col("column") == F.col("__column")) & (F.col("bin") == F.col("median_bin"))
    ).groupBy(long["source_file"], "column", "median_rank", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source_file", "column").orderBy("value"))
    exact = counted.withColumn("upto", upto).where(
        (F.col("upto") >= F.col("median_rank")) & (F.col("upto") - F.col("n") < F.col("median_rank"))
    ).select("source_file", F.col("column").alias("column_name"), F.col("value").alias("__exact"))
    joined = found.join(exact, ["source_file", "column_name"], "left")
    return joined.withColumns({c: F.coalesce("__exact", c) for c in ("median_value", "median_low", "median_high")}).drop("__exact")


def _exceeds(a: Column, b: Column, c: Column, d: Column, points: int) -> Column:
    """Whether the shares a/b and c/d differ by more than ``points`` per cent, without rounding."""
    whole = lambda x: x.cast("decimal(18,0)")
    return F.abs(whole(a) * whole(d) - whole(c) * whole(b)) * 100 > whole(b) * whole(d) * points


def against_previous(profiles: DataFrame, checks: Sequence[Check], *, null_points: int = 5, share: int = 100, median_ratio: float = 1.4) -> DataFrame:
    """Findings ``source_file, column_name, finding`` of each load, held against the previous load of its feed."""
    p = with_previous(profiles)
    kinds = {k.column: k.kind for k in checks}
    values = F.col("row_count") - F.col("nulls")
    kind = F.create_map(*[F.lit(x) for k, v in kinds.items() if v for x in (k, v)])[F.col("column_name")]
    c, d, m = F.col, F.col("distinct_values"), F.col("median_value")
    found = F.array(
        F.when(_exceeds(c("nulls"), c("row_count"), c("previous_nulls"), c("previous_row_count"), null_points), F.lit("null_rate")),
        F.when((c("violations") * share > values) & (values > 0), kind),
        F.when((d * 2 < c("previous_distinct_values")) | (d > c("previous_distinct_values") * 2), F.lit("distinct")),
        F.when((m > c("previous_median_value") * median_ratio) | (c("previous_median_value") > m * median_ratio), F.lit("median")),
    )
    return p.select("source_file", "column_name", F.explode(F.array_compact(found)).alias("finding"))


def against_records(profiles: DataFrame, recorded: DataFrame, zone_columns: Sequence[str]) -> DataFrame:
    """Recorded figures that differ from the load's: ``recorded_nulls`` and ``recorded_zones``."""
    zones = F.when(F.col("column_name").isin(list(zone_columns)), F.col("violations"))
    kept = recorded.select("source_file", "column_name", F.col("nulls").alias("r_nulls"), F.col("zones_out_of_range").alias("r_zones")).distinct()
    both = profiles.select("source_file", "column_name", "nulls", zones.alias("zones")).join(kept, ["source_file", "column_name"])
    found = F.array(F.when(F.col("r_nulls") != F.col("nulls"), F.lit("recorded_nulls")), F.when(F.col("r_zones") != F.col("zones"), F.lit("recorded_zones")))
    return both.select("source_file", "column_name", F.explode(F.array_compact(found)).alias("finding")).distinct()


def rule_rates(counts: DataFrame, *, least_rows: int = 20, ratio: int = 2) -> DataFrame:
    """Rules that matched over ``ratio`` times the share they matched in the feed's previous recorded load."""
    kept = counts.select("source_file", "data_month", "rule_id", "matched_rows", "total_rows").distinct()
    order = Window.partitionBy(feed_of(F.col("source_file")), "rule_id").orderBy("data_month", "source_file")
    p = kept.withColumns({"pm": F.lag("matched_rows").over(order), "pt": F.lag("total_rows").over(order)})
    whole = lambda x: F.col(x).cast("decimal(18,0)")
    more = whole("matched_rows") * whole("pt") > whole("pm") * whole("total_rows") * ratio
    return p.where((F.col("matched_rows") >= least_rows) & more).select(
        "source_file", F.col("rule_id").alias("column_name"), F.lit("rule_rate").alias("finding")
    ).distinct()


def control_limits(profiles: DataFrame, *, sigmas: float = 3.0, least_history: int = 4) -> DataFrame:
    """Metrics outside mean +- ``sigmas`` deviations of all earlier loads of the feed, once it has ``least_history``.

    Of the columns ``nulls, row_count, violations, distinct_values, median_value`` those that ``profiles`` has are held.
    """
    share = lambda part, whole: F.try_divide(part, whole)
    values = F.col("row_count") - F.col("nulls")
    known = {"null_share": share(F.col("nulls"), F.col("row_count")), "row_count": F.col("row_count").cast("double")}
    known |= {"violation_share": share(F.col("violations"), values)} if "violations" in profiles.columns else {}
    known |= {c: F.col(c).cast("double") for c in ("distinct_values", "median_value") if c in profiles.columns}
    entries = F.array(*[F.struct(F.lit(name).alias("metric"), c.alias("value")) for name, c in known.items()])
    long = profiles.select(
        "source_file", "data_month", "column_name", F.inline(entries)
    ).where(F.col("value").isNotNull()).withColumn("feed", feed_of(F.col("source_file")))
    before = Window.partitionBy("feed", "column_name", "metric").orderBy("data_month", "source_file").rowsBetween(Window.unboundedPreceding, -1)
    h = long.withColumns(
        {
            "history": F.count("value").over(before), "centre": F.avg("value").over(before),
            "deviation": F.coalesce(F.stddev_samp("value").over(before), F.lit(0.0))
        }
    )
    return h.where(
        (F.col("history") >= least_history) & (F.abs(F.col("value") - F.col("centre")) > sigmas * F.col("deviation") + 1e-9)
    ).select("source_file", "column_name", "metric", "value", "centre", "deviation", "history")
