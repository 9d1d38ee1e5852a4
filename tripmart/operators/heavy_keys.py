"""Aggregation per key when a few keys hold most rows: two-stage salted aggregation.

1. A frequent-items sketch over the hash of the grouping key finds every group that may hold more than
   ``1 / max_heavy`` of all rows. At most ``max_heavy`` groups can, so the list brought to the driver is
   bounded whatever the size of the data.
2. Rows of those groups get a random salt; partial results are made per (key, salt).
3. The partial results of a key are merged.

Results are those of a plain ``groupBy``: salting moves work, it drops no row. Nulls in a key column form a
group of their own, as in SQL; nulls in a measure are left out of its aggregate; an empty table gives no
groups; repeated rows count as often as they occur; other columns of the table are never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint

_SALT = "__salt"
_HASH = "__key_hash"


@dataclass(frozen=True)
class Partial:
    """An aggregate in two stages: ``first`` over rows, ``merge`` over the partial values, ``last`` for output.

    ``first`` maps a partial's name to its aggregate over rows, ``merge`` names the aggregate function that
    joins two partials, ``last`` makes the result from the merged partials.
    """

    name: str
    first: dict[str, Column]
    merge: dict[str, str]
    last: Column


def count(name: str) -> Partial:
    return Partial(name, {name: F.count(F.lit(1))}, {name: "sum"}, F.col(name))


def total(name: str, value: Column) -> Partial:
    return Partial(name, {name: F.sum(value)}, {name: "sum"}, F.col(name))


def smallest(name: str, value: Column) -> Partial:
    return Partial(name, {name: F.min(value)}, {name: "min"}, F.col(name))


def largest(name: str, value: Column) -> Partial:
    return Partial(name, {name: F.max(value)}, {name: "max"}, F.col(name))


def mean(name: str, value: Column) -> Partial:
    s, n = f"__{name}_sum", f"__{name}_n"
    return Partial(name, {s: F.sum(value), n: F.count(value)}, {s: "sum", n: "sum"}, F.try_divide(F.col(s), F.col(n)))


def distinct_estimate(name: str, value: Column, log2_size: int = 12) -> Partial:
    """A mergeable distinct count (HyperLogLog sketch)."""
    k = f"__{name}_hll"
    return Partial(name, {k: F.hll_sketch_agg(value, log2_size)}, {k: "hll_union_agg"}, F.hll_sketch_estimate(F.col(k)))


def heavy_hashes(keyed: DataFrame, max_heavy: int) -> list[int]:
    """Hashes of the groups that may hold more than 1 / max_heavy of the rows, at most ``2 * max_heavy``.

    The sketch overcounts by less than its error bound and never misses a group above it; a light group
    named by mistake is salted too, which costs a few partial rows and changes no result.
    """
    tracked = max(64, 8 * max_heavy)
    row = keyed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, {2 * max_heavy}, {tracked})").alias("top")).first()
    if not row["n"]:
        return []
    least = row["n"] / max_heavy / 2
    return [x["item"] for x in row["top"] if x["item"] is not None and x["count"] >= least]


def salted_aggregate(df: DataFrame, keys: Sequence[str], parts: Sequence[Partial], *, max_heavy: int = 200, salts: int = 32, seed: int = 17) -> DataFrame:
    """``df.groupBy(keys).agg(parts)`` in two stages, heavy groups spread over ``salts`` reducers.

    A row's salt follows from its place in its partition, so a task run again after a loss gives the same salts where
    it reads the same rows in the same order, as from files. Over a frame that was shuffled before, cut it with
    ``session.checkpoint`` first.
    """
    keyed = df.withColumn(_HASH, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))
    heavy = heavy_hashes(keyed.select(_HASH), max_heavy)
    salt = F.when(F.col(_HASH).isin(heavy), F.floor(F.rand(seed) * salts).cast("int")).otherwise(F.lit(0)) if heavy else F.lit(0)
    columns = [F.col(f"`{k}`") for k in keys]
    first = keyed.withColumn(_SALT, salt).groupBy(*columns, F.col(_SALT)).agg(*[a.alias(n) for p in parts for n, a in p.first.items()])
    merged = first.groupBy(*columns).agg(*[F.expr(f"{f}(`{n}`)").alias(n) for p in parts for n, f in p.merge.items()])
    return merged.select(*columns, *[p.last.alias(p.name) for p in parts])


def value_counts(df: DataFrame, scope: dict[str, Column], fields: dict[str, Column], **salting: int) -> DataFrame:
    """Rows per value of several fields at once: scope columns, ``field_name``, ``key_value`` (text), ``n``.

    One scan serves all fields. Null values are counted under a null ``key_value``.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("field_name"), value.cast("string").alias("key_value")) for name, value in fields.items()])
    long = df.select(*[c.alias(n) for n, c in scope.items()], F.inline(entries))
    return salted_aggregate(long, [*scope, "field_name", "key_value"], [count("n")], **salting)


def heavy_values(counts: DataFrame, scope: Sequence[str], least_share: float) -> DataFrame:
    """The values holding at least ``least_share`` of the rows of their scope; null is counted, but is no value.

    The counts are stored, so the rows behind them are not counted a second time for the totals.
    """
    counts = checkpoint(counts)
    totals = counts.groupBy(*scope, "field_name").agg(F.sum("n").alias("scope_rows"))
    return counts.where(F.col("key_value").isNotNull()).join(totals, [*scope, "field_name"]).where(F.col("n") >= F.lit(least_share) * F.col("scope_rows"))
