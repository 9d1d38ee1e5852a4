"""The queries of problems 5 and 7 to 9 over the tables of a data folder, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import licence
from tripmart.llm import leakage, mixture, radix, residue
from tripmart.session import checkpoint
from tripmart.sources.tables import read

# 5: percentiles of very large numeric columns -------------------------------------------------------------------

POINTS = [2500, 5000, 7500, 9000, 9900]
MEASURES = ("driver_pay", "trip_miles", "base_passenger_fare")
GRAIN = ["data_month", "licence", "zone"]


def _grain() -> dict:
    return {"data_month": F.col("data_month"), "licence": licence(), "zone": F.col("PULocationID")}


def p5_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return radix.percentiles(read(spark, folder, "trips"), _grain(), {m: F.col(m) for m in MEASURES}, POINTS)


def p5_load_histograms(spark: SparkSession, folder: str) -> DataFrame:
    """Histograms of single loads merged into those of months, licences and zones; the interval holds the exact value."""
    groups = {"source_file": F.col("_source_file"), **_grain()}
    single = radix.histogram(radix.measures(read(spark, folder, "trips"), groups, {m: F.col(m) for m in MEASURES}), list(groups))
    return radix.bounded_percentiles(radix.merge(single, GRAIN), GRAIN, POINTS).withColumn("relative_error", F.lit(radix.RELATIVE_ERROR))


def p5_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Each exact percentile, and whether the merged histograms of single loads hold it within their interval and stated error."""
    by = [*GRAIN, "field", "basis_points"]
    near = p5_load_histograms(spark, folder).select(
        *[F.col(c).alias(f"__{c}") for c in by], F.col("value").alias("near"), "low", "high", F.col("group_rows").alias("merged_rows")
    )
    exact = p5_percentiles(spark, folder)
    met = exact.join(near, [exact[c].eqNullSafe(near[f"__{c}"]) for c in by], "left")
    held = (F.col("low") <= F.col("value")) & (F.col("value") <= F.col("high")) & (
        F.abs(F.col("near") - F.col("value")) <= radix.RELATIVE_ERROR * F.abs(F.col("value"))
    )
    return met.select(*by, "value", "merged_rows", F.coalesce(held, F.lit(False)).alias("held"))


P5_PERCENTILES = r"""
    WITH v AS (
      SELECT data_month, upper(regexp_replace(hvfhs_license_num, '^\s+|\s+$', '', 'g')) AS licence, PULocationID AS zone,
             unnest(['driver_pay', 'trip_miles', 'base_passenger_fare']) AS field, unnest([driver_pay, trip_miles, base_passenger_fare]) AS value FROM trips),
    r AS (SELECT *, row_number() OVER (PARTITION BY data_month, licence, zone, field ORDER BY value) AS rank, count(*) OVER (PARTITION BY data_month, licence, zone, field) AS group_rows
          FROM v WHERE value IS NOT NULL AND NOT isnan(value)),
    p AS (SELECT unnest([2500, 5000, 7500, 9000, 9900]) AS basis_points)
    SELECT data_month, licence, zone, field, CAST(basis_points AS INTEGER) AS basis_points, value + 0.0 AS value, group_rows
    FROM r JOIN p ON rank = greatest(1, (basis_points * group_rows + 9999) // 10000)"""

# 7: evaluation texts leaking into training text -----------------------------------------------------------------


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(read(spark, folder, "documents"), read(spark, folder, "eval_items")).where("literal").select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Literal and nearly literal leaks: windows of at least 0.8 weighted shingle similarity."""
    return leakage.leaks(read(spark, folder, "documents"), read(spark, folder, "eval_items"))


# 8: mixing sources to target weights ----------------------------------------------------------------------------


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixture.spread(read(spark, folder, "documents").select("doc_id", mixture.source_name(F.col("source")).alias("source"), "text"))
    return mixture.token_counts(rows, "text").drop("text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    sized, wanted = checkpoint(_sized(spark, folder)), checkpoint(mixture.targets(read(spark, folder, "mix_targets")))
    sizes = checkpoint(mixture.source_sizes(sized))
    size = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    share = wanted.agg(F.coalesce(F.sum("target_share"), F.lit(0.0)).alias("s")).first()["s"]
    longest = sized.agg(F.coalesce(F.max("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    # each source is offered its share of all documents, also where the shares don't add up to 1
    mix = checkpoint(mixture.mixture(sized, wanted, total_tokens=round(size * share)))
    candidates = mixture.stopped(checkpoint(mixture.shares(mix, sizes, wanted)), longest)
    return mixture.unreachable(sizes, wanted).join(candidates, "source", "left_semi").select("source")


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mixture(checkpoint(_sized(spark, folder)), mixture.targets(read(spark, folder, "mix_targets")))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    sized, wanted = checkpoint(_sized(spark, folder)), mixture.targets(read(spark, folder, "mix_targets"))
    return mixture.shares(checkpoint(mixture.mixture(sized, wanted)), mixture.source_sizes(sized), wanted)


BLOCK_CHARACTERS = 2048


def p8_character_quotas(spark: SparkSession, folder: str) -> DataFrame:
    """The same apportionment of blocks of 2,048 characters, which needs no tokenizer: blocks wanted, blocks a source has, blocks given."""
    documents = read(spark, folder, "documents").select(mixture.source_name(F.col("source")).alias("source"), F.length("text").alias("n_tokens"))
    sizes, wanted = mixture.source_sizes(documents), mixture.targets(read(spark, folder, "mix_targets"))
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    known = wanted.join(sizes, "source", "left").orderBy("source").collect()  # the sources of the target table
    blocks = [(r["tokens"] or 0) // BLOCK_CHARACTERS for r in known]
    given = mixture.sainte_lague([r["target_share"] for r in known], [b * r["max_repeats"] for b, r in zip(blocks, known)], total // BLOCK_CHARACTERS)
    return spark.createDataFrame([(r["source"], b, g) for r, b, g in zip(known, blocks, given)], "source string, blocks bigint, given bigint")


P8_CHARACTER_QUOTAS = """
    WITH d AS (SELECT replace(lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')), '_', '-') AS source, length(text) AS n FROM documents),
    t AS (SELECT replace(lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')), '_', '-') AS source, sum(target_share) AS share, max(max_repeats) AS most FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
    s AS (SELECT t.source, share, most, coalesce(sum(n), 0) // 2048 AS blocks FROM t LEFT JOIN d ON t.source = d.source GROUP BY ALL),
    q AS (SELECT source, share / (2 * k + 1) AS quotient FROM s, LATERAL (SELECT unnest(range(0, CAST(blocks * most AS BIGINT))) AS k)),
    g AS (SELECT source, count(*) AS given FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source) AS r FROM q) WHERE r <= (SELECT sum(n) // 2048 FROM d) GROUP BY 1)
    SELECT s.source, CAST(blocks AS BIGINT) AS blocks, coalesce(given, 0) AS given FROM s LEFT JOIN g ON s.source = g.source"""

# 9: template residue and error-page text ------------------------------------------------------------------------


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(read(spark, folder, "documents")).select("doc_id").distinct()


def p9_windows(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(read(spark, folder, "documents"))


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The documents left when those with residue are taken out."""
    documents = read(spark, folder, "documents")
    return residue.excluded(documents, checkpoint(residue.residue(documents).select("doc_id"))).select("doc_id", "source", "lang", "text")


QUERIES = {
    "p5_percentiles": p5_percentiles, "p5_load_histograms": p5_load_histograms, "p5_bounds": p5_bounds, "p7_found": p7_found, "p7_leaks": p7_leaks,
    "p8_found": p8_found, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p8_character_quotas": p8_character_quotas, "p9_found": p9_found, "p9_windows": p9_windows, "p9_kept": p9_kept,
}
SQL = {
    "p8_character_quotas": P8_CHARACTER_QUOTAS,
    "p5_percentiles": P5_PERCENTILES,
    "p5_bounds": f"SELECT data_month, licence, zone, field, basis_points, value, group_rows AS merged_rows, true AS held FROM ({P5_PERCENTILES})",
}
