"""Mixing sources to target weights: Sainte-Lague apportionment of blocks of equal token size.

1. Sizes are tokens of a public tokenizer, counted once for every whole text.
2. Each source is cut into shards of about ``shard_tokens`` by a hash of the document, each shard, in the order of
   a seeded hash, into blocks of ``block_tokens`` tokens.
3. The mixture's blocks go to the sources by highest quotients share / (2 * seats + 1); a source gets at most its
   blocks times ``max_repeats``, what it can't take goes on to the others. The seats of a source go to its
   shards by the same rule, so every shard has an integer quota; shards with as many blocks are equal, so what is
   worked out in one place is a row for each number of blocks a shard has (some thousand), however many shards there are.
4. A shard takes its blocks in seeded order, all of them once before any of them twice.

Documents without text, source or target source are not in the mixture; their tokens still count in the size of
all documents. Empty texts have no tokens and go with the block they fall into. A source without documents
reaches nothing. Targets of the same source (but for case, outer spaces, ``_`` and ``-``) add up, with the
larger repeat cap. With no documents the mixture is empty.
"""

from __future__ import annotations

import base64
import heapq
import math
import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.text import spread
from tripmart.session import checkpoint

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-tokenizer pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a vocabulary file: at ``path`` on every executor, or sent there by ``addFile`` under its name."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(df: DataFrame, text: str, path: str = TOKENIZER) -> DataFrame:
    """``df`` with ``n_tokens``, null where the text is."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode_ordinary
        for s in batches:
            yield pd.Series([None if t is None else len(encode(t)) for t in s], dtype="Int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("n_tokens", F.pandas_udf(count, T.LongType())(F.col(text)))


def source_name(c: Column) -> Column:
    return F.replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), F.lit("_"), F.lit("-"))


def targets(table: DataFrame) -> DataFrame:
    return table.where(F.col("source").isNotNull()).groupBy(source_name(F.col("source")).alias("source")).agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )


def source_sizes(sized: DataFrame) -> DataFrame:
    """Documents and tokens per source, sources with null too; combined before the shuffle, so large sources don't matter."""
    return sized.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n_tokens"), F.lit(0).cast("bigint")).alias("tokens"))


def unreachable(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sources whose size, repeated as often as allowed, is below their share of the size of all documents."""
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).scalar()
    joined = wanted.join(sizes.where(F.col("source").isNotNull()), "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    return joined.where(F.col("tokens") * F.col("max_repeats") < F.col("target_share") * total)


def _rounded(weights: Sequence[float], caps: Sequence[int], counts: Sequence[int], seats: int) -> list[int]:
    """Seats of one divisor, rounded to the nearest, near ``seats`` in all: each party at its cap or at its share of what the others leave."""
    left, active = seats, [i for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    got = [0] * len(weights)
    while active:
        total = sum(weights[i] * counts[i] for i in active)
        full = [i for i in active if left * weights[i] / total >= caps[i]]
        if not full:
            for i in active:
                got[i] = min(caps[i], math.floor(left * weights[i] / total + 0.5))
            break
        for i in full:
            got[i] = caps[i]
            left -= caps[i] * counts[i]
        active = [i for i in active if i not in set(full)]
    return got


def apportion(weights: Sequence[float], caps: Sequence[int], counts: Sequence[int], seats: int) -> tuple[list[int], list[int]]:
    """Seats by highest quotients weight / (2 s + 1) where each entry stands for ``counts`` equal parties.

    Gives the seats of each party of an entry, and how many of its parties, the first, get one more. The seats are
    rounded at once from one divisor; what is over or missing then, at most one an entry, is settled by the quotients.
    """
    got, more = _rounded(weights, caps, counts, seats), [0] * len(weights)
    over = sum(g * c for g, c in zip(got, counts)) - seats
    if over > 0:  # the lowest quotients leave first, of equal ones the last
        queue = [(w / (2 * g - 1), -i) for i, (w, g) in enumerate(zip(weights, got)) if g > 0]
        heapq.heapify(queue)
        while over > 0:
            _, i = heapq.heappop(queue)
            i, gone = -i, min(over, counts[-i])
            got[i] -= 1
            over -= gone
            more[i] = counts[i] - gone
            if over and got[i] > 0:
                heapq.heappush(queue, (weights[i] / (2 * got[i] - 1), -i))
    elif over < 0:
        queue = [(-w / (2 * g + 1), i) for i, (w, g) in enumerate(zip(weights, got)) if w > 0 and g < caps[i]]
        heapq.heapify(queue)
        while over < 0 and queue:
            _, i = heapq.heappop(queue)
            if -over < counts[i]:
                more[i], over = -over, 0
                break
            got[i] += 1
            over += counts[i]
            if got[i] < caps[i]:
                heapq.heappush(queue, (-weights[i] / (2 * got[i] + 1), i))
    return got, more


def sainte_lague(weights: Sequence[float], caps: Sequence[int], seats: int) -> list[int]:
    """Seats by highest quotients weight / (2 s + 1), at most ``caps`` each; ties go to the first. Seats that no source may take stay empty."""
    seats = min(seats, sum(c for w, c in zip(weights, caps) if w > 0))
    got, more = apportion(weights, caps, [1] * len(weights), seats)
    return [g + m for g, m in zip(got, more)]


def mixture(
    sized: DataFrame, wanted: DataFrame, *, doc_id: str = "doc_id", total_tokens: int | None = None, block_tokens: int = 512,
    shard_tokens: int = 4_000_000, seed: int = 11
) -> DataFrame:
    """``doc_id, source, n_tokens, repeats``: the documents taken. ``sized`` should be stored: it is read twice.

    ``total_tokens`` is the size aimed at, by default that of all documents.
    """
    sized = sized.select(doc_id, "source", "n_tokens")
    sizes = source_sizes(sized)
    shards = sizes.join(wanted, "source").select("source", F.greatest(F.lit(1), F.ceil(F.col("tokens") / shard_tokens)).cast("int").alias("shards"))
    place = F.xxhash64(F.col(doc_id), F.lit(seed))
    rows = sized.where(F.col("n_tokens").isNotNull()).join(shards, "source").withColumns(
        {"place": place, "shard": F.pmod(F.xxhash64(F.col(doc_id), F.lit(seed + 1)), F.col("shards")).cast("int")}
    )
    order = Window.partitionBy("source", "shard").orderBy("place", doc_id).rowsBetween(Window.unboundedPreceding, 0)
    blocked = rows.withColumn("block", F.floor((F.sum("n_tokens").over(order) - F.col("n_tokens")) / block_tokens))
    blocks = checkpoint(blocked.groupBy("source", "shard").agg((F.max("block") + 1).alias("blocks")))  # a row for each shard
    # the sources are those of the target table; their block counts and seats are a few rows
    known = {r["source"]: r for r in wanted.join(blocks.groupBy("source").agg(F.sum("blocks").alias("blocks")), "source", "left").collect()}
    total = total_tokens if total_tokens is not None else sizes.agg(F.sum("tokens")).first()[0] or 0
    names = sorted(known)
    caps = [int((known[n]["blocks"] or 0) * known[n]["max_repeats"]) for n in names]
    seats = dict(zip(names, sainte_lague([known[n]["target_share"] for n in names], caps, round(total / block_tokens))))
    repeats = {n: known[n]["max_repeats"] for n in names}

    # shards of a source with as many blocks are equal parties: what goes to the driver is one row for each number of blocks a shard has
    alike = blocks.groupBy("source", "blocks").agg(F.count(F.lit(1)).alias("count"))
    sent = {}
    for r in alike.orderBy("source", F.desc("blocks")).toLocalIterator():
        sent.setdefault(r["source"], []).append((r["blocks"], r["count"]))
    rows = []
    for name, parties in sent.items():
        weights, counts = [float(b) for b, _ in parties], [c for _, c in parties]
        got, more = apportion(weights, [b * repeats[name] for b, _ in parties], counts, seats[name])
        rows += [(name, b, g, m) for (b, _), g, m in zip(parties, got, more)]
    shares_of = sized.sparkSession.createDataFrame(rows, "source string, blocks bigint, each bigint, more bigint")
    first = F.row_number().over(Window.partitionBy("source", "blocks").orderBy("shard")) <= F.col("more")
    per_shard = blocks.join(shares_of, ["source", "blocks"]).withColumn(
        "quota", F.col("each") + F.when((F.col("more") > 0) & first, 1).otherwise(0)
    ).select("source", "shard", "blocks", "quota")
    taken = blocked.join(per_shard, ["source", "shard"])
    times = F.floor(F.col("quota") / F.col("blocks")) + F.when(F.col("block") < F.col("quota") % F.col("blocks"), 1).otherwise(0)
    return taken.select(doc_id, "source", "n_tokens", times.cast("int").alias("repeats")).where("repeats > 0")


def shares(mix: DataFrame, sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Target and reached share, size and tokens taken of each source of the target table."""
    total = mix.agg(F.sum(F.col("n_tokens") * F.col("repeats"))).scalar()
    taken = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("taken_tokens"), F.max("repeats").alias("most_repeats"))
    zero = F.lit(0).cast("bigint")
    out = wanted.join(sizes, "source", "left").join(taken, "source", "left")
    return out.select(
        "source", "target_share", "max_repeats", F.coalesce("tokens", zero).alias("source_tokens"),
        F.coalesce("taken_tokens", zero).alias("taken_tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.coalesce(F.try_divide("taken_tokens", total), F.lit(0.0)).alias("reached_share")
    )


def stopped(reached: DataFrame, longest: int, *, block_tokens: int = 512, shard_tokens: int = 4_000_000) -> DataFrame:
    """Sources of ``shares`` that gave all they may but for whole blocks: a last block a shard and a seat a source, each as large as a block may be."""
    seats = F.greatest(F.lit(1), F.ceil(F.col("source_tokens") / shard_tokens)) * F.col("max_repeats") + F.lit(reached.count() + 1)
    return reached.where(F.col("taken_tokens") + seats * (block_tokens + longest) >= F.col("source_tokens") * F.col("max_repeats")).select("source")
