"""The queries of problems 1 to 4 and 6 over the tables of a data folder, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import rules
from tripmart.functions.columns import feed_of, licence, month_text
from tripmart.operators import drift, heavy_keys, kslack, orphans, profile
from tripmart.operators.orphans import OrphanState
from tripmart.session import checkpoint, checkpoint_dir
from tripmart.sources.tables import read
from tripmart.streaming.slack import SlackStream

HEAVY_SHARE = 0.05


# 1: a few keys holding most records ---------------------------------------------------------------------------


def _key_counts(spark: SparkSession, folder: str) -> DataFrame:
    trips = read(spark, folder, "trips").where(F.col("data_month").isNotNull())
    return heavy_keys.value_counts(trips, {"data_month": month_text()}, {"hvfhs_license_num": licence(), "PULocationID": F.col("PULocationID")})


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return heavy_keys.heavy_values(_key_counts(spark, folder), ["data_month"], HEAVY_SHARE).select("data_month", "field_name", "key_value")


def p1_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _key_counts(spark, folder)


def p1_licence_zone_stats(spark: SparkSession, folder: str) -> DataFrame:
    trips = read(spark, folder, "trips").withColumn("licence", licence())
    cents = F.round(F.col("driver_pay") * 100).cast("bigint")
    parts = [
        heavy_keys.count("trips"), heavy_keys.total("pay_cents", cents), heavy_keys.smallest("least_miles", F.col("trip_miles")),
        heavy_keys.largest("most_miles", F.col("trip_miles")), heavy_keys.mean("mean_trip_seconds", F.col("trip_time"))
    ]
    return heavy_keys.salted_aggregate(trips, ["licence", "PULocationID"], parts).withColumn("mean_trip_seconds", F.round("mean_trip_seconds", 3))


P1_COUNTS = r"""
    SELECT strftime(data_month, '%Y-%m') AS data_month, 'hvfhs_license_num' AS field_name,
           upper(regexp_replace(hvfhs_license_num, '^\s+|\s+$', '', 'g')) AS key_value, count(*) AS n
    FROM trips WHERE data_month IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT strftime(data_month, '%Y-%m'), 'PULocationID', CAST(PULocationID AS VARCHAR), count(*)
    FROM trips WHERE data_month IS NOT NULL GROUP BY ALL"""

# 2: schemas that drift between files --------------------------------------------------------------------------


def _contract(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """The contract's columns and types, in order: as many rows as a trip has columns."""
    return [(r["name"], r["spark_type"]) for r in read(spark, folder, "contract_columns").orderBy("position_no").collect()]


def _headers(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Headers and aliases, both of the size of the schemas, not of the records."""
    contract = _contract(spark, folder)
    header = checkpoint(drift.headers(read(spark, folder, "raw_trip_records")))
    return header, checkpoint(drift.aliases(header, [n for n, _ in contract])), contract


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    header, alias, contract = _headers(spark, folder)
    return drift.changes(drift.resolved(header, alias, [n for n, _ in contract]))


def p2_differences(spark: SparkSession, folder: str) -> DataFrame:
    """The log of changes, in the order of the files, with types before and now and what the fold promotes them to."""
    header, alias, contract = _headers(spark, folder)
    return drift.differences(drift.resolved(header, alias, [n for n, _ in contract]))


def p2_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of each file, the records that carry them and the type of most of their values."""
    found = drift.headers(read(spark, folder, "raw_trip_records"))
    return found.select(F.col("file").alias("source_file"), "key", "type", "present", "filled", "records")


P2_HEADERS = """
    WITH r AS (SELECT record_id, source_file, CAST(payload AS JSON) AS j FROM raw_trip_records WHERE json_type(TRY_CAST(payload AS JSON)) = 'OBJECT' AND source_file IS NOT NULL),
    k AS (SELECT source_file, unnest(json_keys(j)) AS key, j FROM r),
    t AS (SELECT source_file, key, json_type(json_extract(j, '$."' || key || '"')) AS t FROM k),
    m AS (SELECT *, CASE WHEN t = 'NULL' THEN NULL WHEN t = 'BOOLEAN' THEN 1 WHEN t IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 2 WHEN t = 'DOUBLE' THEN 3 WHEN t = 'VARCHAR' THEN 4 ELSE 5 END AS kind FROM t),
    n AS (SELECT source_file, count(*) AS records FROM r GROUP BY 1),
    c AS (SELECT source_file, key, count(*) AS present, count(kind) AS filled FROM m GROUP BY ALL),
    b AS (SELECT source_file, key, arg_max(kind, (n, kind)) AS kind FROM (SELECT source_file, key, kind, count(*) AS n FROM m WHERE kind IS NOT NULL GROUP BY ALL) GROUP BY ALL)
    SELECT c.source_file, c.key, CASE b.kind WHEN 1 THEN 'boolean' WHEN 2 THEN 'whole number' WHEN 3 THEN 'decimal number' WHEN 4 THEN 'string' WHEN 5 THEN 'nested' END AS type, present, filled, records
    FROM c JOIN n ON c.source_file = n.source_file LEFT JOIN b ON c.source_file = b.source_file AND c.key = b.key WHERE present * 2 >= records"""


def p2_table(spark: SparkSession, folder: str) -> DataFrame:
    header, alias, contract = _headers(spark, folder)
    return drift.consistent_table(read(spark, folder, "raw_trip_records"), header, alias, contract)


def p2_union_schema(spark: SparkSession, folder: str) -> DataFrame:
    header, alias, contract = _headers(spark, folder)
    return drift.union_schema(drift.resolved(header, alias, [n for n, _ in contract]))


def p2_aliases(spark: SparkSession, folder: str) -> DataFrame:
    return _headers(spark, folder)[1]


def p2_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    return drift.unreadable(read(spark, folder, "raw_trip_records"))


# 3: late and out-of-order events ------------------------------------------------------------------------------

WINDOW_MINUTES, SLACK_MINUTES, TICK_MINUTES = 15, 30, 15


def _slack(spark: SparkSession, folder: str) -> SlackStream:
    """The stream after all sendings, in batches, and the end of all days."""
    events = read(spark, folder, "pickup_events").select("event_date", "event_id", "pickup_zone_id", "event_time", "send_time")
    stream = SlackStream(f"{checkpoint_dir(spark)}/slack/{uuid.uuid4().hex}", WINDOW_MINUTES, SLACK_MINUTES, TICK_MINUTES)
    stream.take(events)
    stream.close(spark)
    return stream


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _slack(spark, folder).read(spark, "late").select("event_id")


def p3_windows(spark: SparkSession, folder: str) -> DataFrame:
    stream = _slack(spark, folder)
    return kslack.with_late(stream.read(spark, "final"), stream.read(spark, "late"), ["event_date", "pickup_zone_id"])


def p3_revisions(spark: SparkSession, folder: str) -> DataFrame:
    return kslack.with_final(_slack(spark, folder).read(spark, "published"), ["event_date", "pickup_zone_id"])


_P3 = """
    WITH f AS (SELECT * FROM pickup_events WHERE event_id IS NOT NULL AND send_time IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_date, event_id ORDER BY send_time) = 1),
    k AS (SELECT * FROM f WHERE event_time IS NOT NULL AND pickup_zone_id IS NOT NULL),
    m AS (SELECT *, max(event_time) OVER (PARTITION BY event_date ORDER BY send_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS seen,
          time_bucket(INTERVAL '15 minutes', event_time) AS window_start FROM k),
    j AS (SELECT *, coalesce(window_start + INTERVAL '15 minutes' <= seen - INTERVAL '30 minutes', false) AS late FROM m)"""
P3_FOUND = _P3 + " SELECT event_id FROM j WHERE late"
P3_WINDOWS = _P3 + """,
    o AS (SELECT *, date_diff('microsecond', lag(event_time) OVER w, event_time) AS gap FROM j WHERE NOT late WINDOW w AS (PARTITION BY event_date, pickup_zone_id, window_start ORDER BY event_time, event_id)),
    a AS (SELECT event_date, pickup_zone_id, window_start, count(*) AS trips, max(gap) // 1000000 AS longest_gap_seconds, arg_min(event_id, (event_time, event_id)) AS first_event, arg_max(event_id, (event_time, event_id)) AS last_event FROM o GROUP BY ALL),
    l AS (SELECT event_date, pickup_zone_id, window_start, count(*) AS late_trips FROM j WHERE late GROUP BY ALL)
    SELECT coalesce(a.event_date, l.event_date) AS event_date, coalesce(a.pickup_zone_id, l.pickup_zone_id) AS pickup_zone_id, coalesce(a.window_start, l.window_start) AS window_start,
      coalesce(trips, 0) AS trips, longest_gap_seconds, first_event, last_event, coalesce(late_trips, 0) AS late_trips
    FROM a FULL JOIN l ON a.event_date = l.event_date AND a.pickup_zone_id = l.pickup_zone_id AND a.window_start = l.window_start"""

P3_REVISIONS = _P3 + """,
    t AS (SELECT event_date, pickup_zone_id, window_start, time_bucket(INTERVAL '15 minutes', send_time) + INTERVAL '15 minutes' AS published_at, count(*) AS new_trips FROM j WHERE NOT late GROUP BY ALL)
    SELECT *, CAST(sum(new_trips) OVER w AS BIGINT) AS trips_so_far, CAST(row_number() OVER w AS INTEGER) AS revision, lead(published_at) OVER w IS NULL AS is_final
    FROM t WINDOW w AS (PARTITION BY event_date, pickup_zone_id, window_start ORDER BY published_at)"""

# 4: references to records that do not exist -------------------------------------------------------------------

REFERENCES = ["pickup_zone_key", "date_key", "company_key"]


def orphan_state(spark: SparkSession, folder: str) -> OrphanState:
    """The state after all months of the facts, with the parents that came and went in each."""
    lives = orphans.parents(read(spark, folder, "dim_zone"), "pickup_zone_key", "zone_key", "first_loaded", "removed_on")
    lives = lives.unionByName(orphans.parents(read(spark, folder, "dim_company"), "company_key", "company_key", "first_loaded", "removed_on"))
    lives = lives.unionByName(orphans.parents(read(spark, folder, "dim_date"), "date_key", "date_key"))
    state = OrphanState(spark, f"{checkpoint_dir(spark)}/orphans/{uuid.uuid4().hex}", ("date_key",))
    state.replay(orphans.references(read(spark, folder, "fct_trips"), REFERENCES, "data_month"), lives)
    return state


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = orphan_state(spark, folder).read("found")
    return orphans.orphan_rows(
        read(spark, folder, "fct_trips").select("trip_key", *REFERENCES, "data_month"), found, REFERENCES, "data_month"
    ).select("trip_key", "ref_column")


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_state(spark, folder).read("snapshots")


P4_FOUND = """
    WITH refs AS (
      SELECT trip_key, 'pickup_zone_key' AS ref_column, CAST(pickup_zone_key AS BIGINT) AS k, data_month FROM fct_trips
      UNION ALL SELECT trip_key, 'company_key', company_key, data_month FROM fct_trips
      UNION ALL SELECT trip_key, 'date_key', CAST(date_key AS BIGINT), data_month FROM fct_trips),
    lives AS (
      SELECT 'pickup_zone_key' AS ref_column, CAST(zone_key AS BIGINT) AS k, first_loaded AS b, removed_on AS e FROM dim_zone
      UNION ALL SELECT 'company_key', company_key, first_loaded, removed_on FROM dim_company
      UNION ALL SELECT 'date_key', CAST(date_key AS BIGINT), NULL, NULL FROM dim_date)
    SELECT trip_key, ref_column FROM refs r WHERE k IS NOT NULL AND (data_month IS NOT NULL OR ref_column = 'date_key') AND NOT EXISTS (
      SELECT 1 FROM lives l WHERE l.ref_column = r.ref_column AND l.k = r.k
        AND (l.b IS NULL OR l.b <= last_day(r.data_month)) AND (l.e IS NULL OR l.e > date_trunc('month', r.data_month)))"""

P4_REPORT = """
    WITH refs AS (
      SELECT 'pickup_zone_key' AS ref_column, CAST(pickup_zone_key AS BIGINT) AS k, CAST(date_trunc('month', data_month) AS DATE) AS period FROM fct_trips
      UNION ALL SELECT 'company_key', company_key, CAST(date_trunc('month', data_month) AS DATE) FROM fct_trips
      UNION ALL SELECT 'date_key', CAST(date_key AS BIGINT), CAST(date_trunc('month', data_month) AS DATE) FROM fct_trips),
    counted AS (SELECT ref_column, k, period, count(*) AS n FROM refs WHERE k IS NOT NULL GROUP BY ALL),
    lives AS (
      SELECT 'pickup_zone_key' AS ref_column, CAST(zone_key AS BIGINT) AS k, first_loaded AS b, coalesce(removed_on, DATE '9999-12-31') AS e FROM dim_zone
      UNION ALL SELECT 'company_key', company_key, first_loaded, coalesce(removed_on, DATE '9999-12-31') FROM dim_company
      UNION ALL SELECT 'date_key', CAST(date_key AS BIGINT), DATE '0001-01-01', DATE '9999-12-31' FROM dim_date),
    judged AS (SELECT *, (period IS NOT NULL OR ref_column = 'date_key') AND NOT EXISTS (SELECT 1 FROM lives l WHERE l.ref_column = c.ref_column AND l.k = c.k
      AND (l.b = DATE '0001-01-01' AND l.e = DATE '9999-12-31' OR l.b <= last_day(c.period) AND l.e > c.period)) AS orphan FROM counted c),
    times AS (SELECT DISTINCT period AS at FROM counted),
    found AS (SELECT ref_column, period, sum(n) AS r, sum(CASE WHEN orphan THEN n ELSE 0 END) AS o, count(*) FILTER (WHERE orphan) AS ok FROM judged GROUP BY ALL),
    waits AS (
      SELECT j.ref_column, t.at AS period, sum(j.n) AS w FROM judged j JOIN times t ON t.at >= j.period
      WHERE j.orphan AND NOT EXISTS (SELECT 1 FROM lives l WHERE l.ref_column = j.ref_column AND l.k = j.k AND l.b <= last_day(t.at) AND l.e > last_day(t.at)) GROUP BY ALL)
    SELECT f.ref_column, f.period, CAST(r AS BIGINT) AS "references", CAST(o AS BIGINT) AS orphans, CAST(ok AS BIGINT) AS orphan_keys, CAST(coalesce(w, 0) AS BIGINT) AS waiting
    FROM found f LEFT JOIN waits w ON f.ref_column = w.ref_column AND f.period = w.period"""

# 6: column-level data quality profile -------------------------------------------------------------------------

_CODE = {"hvfhs_license_num": r"^HV[0-9]{4}\z", "dispatching_base_num": r"^B[0-9]{5}\z", "originating_base_num": r"^B[0-9]{5}\z"}
_FLAGS = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag"]
_TIMES = ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime"]
_ZONES = ["PULocationID", "DOLocationID"]
_AMOUNTS = [
    "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips",
    "driver_pay", "cbd_congestion_fee"
]
_MEDIANS = ["trip_miles", "trip_time", "base_passenger_fare", "driver_pay"]
TRIP_CHECKS = [
    *[profile.Check(c, pattern=p, distinct=True) for c, p in _CODE.items()],
    *[profile.Check(c) for c in _TIMES],
    *[profile.Check(c, least=1, most=265, distinct=True) for c in _ZONES],
    *[profile.Check(c, least=0, median=c in _MEDIANS) for c in _AMOUNTS],
    *[profile.Check(c, pattern=r"^[YN]\z") for c in _FLAGS],
]


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    # small (a row per load and column), read several times
    return checkpoint(profile.column_profiles(read(spark, folder, "trips"), "_source_file", "data_month", TRIP_CHECKS))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(spark, folder)
    found = profile.against_previous(profile.settled(profiles, read(spark, folder, "trips"), "_source_file", TRIP_CHECKS), TRIP_CHECKS)
    found = found.unionByName(profile.against_records(profiles, read(spark, folder, "load_profiles"), _ZONES))
    return found.unionByName(profile.rule_rates(read(spark, folder, "rule_counts")))


def p6_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Exact figures of every column of the contract."""
    return _profiles(spark, folder).select(
        "source_file", "data_month", "column_name", "row_count", "nulls", "violations", "distinct_values", "min_value", "max_value",
        "negative_rows", "zero_rows"
    )


def p6_feed_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The same of whole feeds, from the merged states of their loads."""
    trips = read(spark, folder, "trips")
    states = profile.column_states(trips, "_source_file", "data_month", TRIP_CHECKS)
    merged = profile.profiles(profile.merge_states(states, feed_of(F.col("source_file"))), TRIP_CHECKS, dict(trips.dtypes))
    return merged.select(
        F.col("source_file").alias("feed"), "column_name", "row_count", "nulls", "violations", "distinct_values", "min_value", "max_value",
        "negative_rows", "zero_rows"
    )


def p6_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, distinct values (estimated), range and median of every column of every load; ``p6_profile`` has the exact counts of valid codes."""
    trips = read(spark, folder, "trips")
    names = [c for c in trips.columns if c not in ("_source_file", "data_month")]
    known = _profiles(spark, folder).select("source_file", "column_name", "violations", F.col("distinct_values").alias("valid_values"), "median_value")
    found = profile.sketches(trips, "_source_file", names).withColumn(
        "distinct_values", F.when(F.col("nulls") < F.col("row_count"), F.hll_sketch_estimate("sketch"))
    ).drop("sketch")
    return found.join(known, ["source_file", "column_name"], "left")


def _limits(found: DataFrame) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in ("value", "centre", "deviation")]
    return profile.control_limits(found).select("source_file", "column_name", "metric", *rounded, "history")


def p6_control_limits(spark: SparkSession, folder: str) -> DataFrame:
    """The exact metrics of every column of the contract against the history of the feed."""
    return _limits(_profiles(spark, folder).drop("median_value"))


def p6_control_limits_estimated(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values of every column (estimated where they are no codes) and medians against the history of the feed."""
    found = p6_columns(spark, folder).withColumn("distinct_values", F.coalesce("valid_values", "distinct_values"))
    return _limits(found).where(F.col("metric").isin("distinct_values", "median_value"))


def p6_recorded_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rows each rule matches in a load, against what was recorded of it; null where nothing was."""
    loads = read(spark, folder, "trips").where(F.col("_source_file").isNotNull())
    found = rules.counts(rules.evaluate(loads, within=("_source_file",)), ("_source_file",)).select(
        F.col("_source_file").alias("source_file"), "rule_id", "matched_rows", "total_rows"
    )
    recorded = read(spark, folder, "rule_counts").select("source_file", "rule_id", F.col("matched_rows").alias("recorded_rows")).distinct()
    return found.join(recorded, ["source_file", "rule_id"], "left").withColumn("agrees", F.col("matched_rows") == F.col("recorded_rows"))


def _p6_column_sql(k: profile.Check, load: str = "_source_file") -> str:
    c, number = f'"{k.column}"', k.column in _ZONES + _AMOUNTS
    bad = f"NOT regexp_full_match({c}, '{k.pattern.strip('^').removesuffix(chr(92) + 'z')}')" if k.pattern else f"{c} NOT BETWEEN 1 AND 265" if k.column in _ZONES else f"{c} < 0"
    return f"""
    SELECT {load} AS source_file, min(data_month) AS data_month, '{k.column}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls,
      {f"count(*) FILTER (WHERE {bad})" if k.kind else "NULL::BIGINT"} AS violations, {f"count(DISTINCT {c}) FILTER (WHERE NOT ({bad}))" if k.distinct else "NULL::BIGINT"} AS distinct_values,
      {f"CAST(min({c}) AS DOUBLE)" if number else "NULL::DOUBLE"} AS min_value, {f"CAST(max({c}) AS DOUBLE)" if number else "NULL::DOUBLE"} AS max_value,
      {f"count(*) FILTER (WHERE {c} < 0)" if number else "NULL::BIGINT"} AS negative_rows, {f"count(*) FILTER (WHERE {c} = 0)" if number else "NULL::BIGINT"} AS zero_rows,
      {f"quantile_disc({c}, 0.5)::DOUBLE" if k.median else "NULL::DOUBLE"} AS median_value
    FROM trips WHERE _source_file IS NOT NULL GROUP BY 1"""


_P6_BASE = " UNION ALL ".join(_p6_column_sql(k) for k in TRIP_CHECKS)
P6_PROFILE = f"SELECT source_file, data_month, column_name, row_count, nulls, violations, distinct_values, min_value, max_value, negative_rows, zero_rows FROM ({_P6_BASE})"
_FEED = "regexp_extract(_source_file, '_([^_.]+)[.][^.]*$', 1)"
P6_FEED_PROFILE = "SELECT source_file AS feed, column_name, row_count, nulls, violations, distinct_values, min_value, max_value, negative_rows, zero_rows FROM (" + " UNION ALL ".join(
    _p6_column_sql(k, _FEED) for k in TRIP_CHECKS
) + ")"
P6_CONTROL_LIMITS = f"""
    WITH m AS (
      SELECT source_file, data_month, column_name, unnest(['null_share', 'row_count', 'violation_share', 'distinct_values']) AS metric,
        unnest([nulls / row_count, CAST(row_count AS DOUBLE), violations / nullif(row_count - nulls, 0), CAST(distinct_values AS DOUBLE)]) AS value FROM ({_P6_BASE})),
    h AS (SELECT *, count(value) OVER w AS history, avg(value) OVER w AS centre, coalesce(stddev_samp(value) OVER w, 0) AS deviation FROM m WHERE value IS NOT NULL
      WINDOW w AS (PARTITION BY regexp_extract(source_file, '_([^_.]+)[.][^.]*$', 1), column_name, metric ORDER BY data_month, source_file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT source_file, column_name, metric, round(value, 6) AS value, round(centre, 6) AS centre, round(deviation, 6) AS deviation, history FROM h
    WHERE history >= 4 AND abs(value - centre) > 3 * deviation + 1e-9"""
P6_FOUND = f"""
    WITH base AS ({_P6_BASE}),
    p AS (SELECT *, lag(row_count) OVER w AS pr, lag(nulls) OVER w AS pn, lag(distinct_values) OVER w AS pd, lag(median_value) OVER w AS pm FROM base
          WINDOW w AS (PARTITION BY regexp_extract(source_file, '_([^_.]+)[.][^.]*$', 1), column_name ORDER BY data_month, source_file)),
    q AS (SELECT DISTINCT source_file, data_month, rule_id, matched_rows AS m, total_rows AS t FROM rule_counts),
    qq AS (SELECT *, lag(m) OVER w AS pm, lag(t) OVER w AS pt FROM q WINDOW w AS (PARTITION BY regexp_extract(source_file, '_([^_.]+)[.][^.]*$', 1), rule_id ORDER BY data_month, source_file))
    SELECT source_file, column_name, 'null_rate' AS finding FROM p WHERE abs(nulls * pr - pn * row_count) * 20 > row_count * pr
    UNION ALL SELECT source_file, column_name, CASE WHEN column_name LIKE '%\\_num' ESCAPE '\\' OR column_name LIKE '%flag' THEN 'pattern' ELSE 'range' END FROM p WHERE violations * 100 > row_count - nulls
    UNION ALL SELECT source_file, column_name, 'distinct' FROM p WHERE distinct_values * 2 < pd OR distinct_values > 2 * pd
    UNION ALL SELECT source_file, column_name, 'median' FROM p WHERE median_value > 1.4 * pm OR pm > 1.4 * median_value
    UNION ALL SELECT DISTINCT b.source_file, b.column_name, 'recorded_nulls' FROM base b JOIN load_profiles l ON b.source_file = l.source_file AND b.column_name = l.column_name WHERE l.nulls <> b.nulls
    UNION ALL SELECT DISTINCT b.source_file, b.column_name, 'recorded_zones' FROM base b JOIN load_profiles l ON b.source_file = l.source_file AND b.column_name = l.column_name WHERE b.column_name LIKE '%LocationID' AND l.zones_out_of_range <> b.violations
    UNION ALL SELECT DISTINCT source_file, rule_id, 'rule_rate' FROM qq WHERE m >= 20 AND m * pt > 2 * pm * t"""

QUERIES = {
    "p1_found": p1_found, "p1_key_counts": p1_key_counts, "p1_licence_zone_stats": p1_licence_zone_stats,
    "p2_found": p2_found, "p2_differences": p2_differences, "p2_headers": p2_headers, "p2_table": p2_table, "p2_union_schema": p2_union_schema, "p2_aliases": p2_aliases, "p2_unreadable": p2_unreadable,
    "p3_found": p3_found, "p3_windows": p3_windows, "p3_revisions": p3_revisions,
    "p4_found": p4_found, "p4_report": p4_report,
    "p6_found": p6_found, "p6_profile": p6_profile, "p6_columns": p6_columns, "p6_feed_profile": p6_feed_profile, "p6_control_limits": p6_control_limits, "p6_control_limits_estimated": p6_control_limits_estimated, "p6_recorded_rules": p6_recorded_rules,
}

SQL = {
    "p1_found": f"""
    WITH c AS ({P1_COUNTS}), t AS (SELECT data_month, field_name, sum(n) AS s FROM c GROUP BY ALL)
    SELECT c.data_month, c.field_name, c.key_value FROM c JOIN t ON c.data_month = t.data_month AND c.field_name = t.field_name WHERE c.key_value IS NOT NULL AND c.n >= 0.05 * t.s""",
    "p1_key_counts": P1_COUNTS,
    "p1_licence_zone_stats": r"""
    SELECT upper(regexp_replace(hvfhs_license_num, '^\s+|\s+$', '', 'g')) AS licence, PULocationID, count(*) AS trips, CAST(sum(CAST(round(driver_pay * 100) AS BIGINT)) AS BIGINT) AS pay_cents,
      min(trip_miles) AS least_miles, max(trip_miles) AS most_miles, round(CAST(sum(trip_time) AS DOUBLE) / count(trip_time), 3) AS mean_trip_seconds
    FROM trips GROUP BY 1, 2""",
    "p2_unreadable": """SELECT source_file, count(*) AS lines, count(*) - count(CASE WHEN json_type(TRY_CAST(payload AS JSON)) = 'OBJECT' THEN 1 END) AS unreadable_lines FROM raw_trip_records GROUP BY 1""",
    "p2_headers": P2_HEADERS,
    "p3_found": P3_FOUND, "p3_windows": P3_WINDOWS, "p3_revisions": P3_REVISIONS,
    "p4_found": P4_FOUND, "p4_report": P4_REPORT,
    "p6_found": P6_FOUND, "p6_profile": P6_PROFILE, "p6_feed_profile": P6_FEED_PROFILE, "p6_control_limits": P6_CONTROL_LIMITS,
}
