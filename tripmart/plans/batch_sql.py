"""The SQL of the batch queries, for an independent engine."""

from __future__ import annotations

from tripmart.contract import NAMES
from tripmart.plans.batch import PERIOD
from tripmart.profiling import FLAGS
from tripmart.rules import IDENTITY, REJECT, RULES, SHARED

_COLUMNS = ", ".join(f'"{n}"' for n in NAMES)
_CONDITION = {r.id: r.violated.replace("add_months(data_month, 1)", "data_month + INTERVAL 1 MONTH").replace(SHARED, "shared") for r in RULES}


def _ids(severity: str) -> str:
    cases = ", ".join(f"CASE WHEN {_CONDITION[r.id]} THEN '{r.id}' END" for r in RULES if r.severity == severity)
    return f"concat_ws(',', {cases})"


def _h(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def _ratio(part: str, whole: str, digits: int) -> str:
    s = 10**digits
    return f"CASE WHEN {whole} > 0 THEN CAST((abs(CAST({part} AS HUGEINT)) * {2 * s} + CAST({whole} AS HUGEINT)) // (CAST({whole} AS HUGEINT) * 2) AS DOUBLE) * sign(CAST({part} AS DOUBLE)) / {float(s)} END"


_EVALUATED = f"""keyed AS (SELECT *, count(*) OVER (PARTITION BY {', '.join(f'"{c}"' for c in IDENTITY)}, data_month) AS shared FROM trips),
    ev AS (SELECT *, {_ids(REJECT)} AS failed_rules, {_ids("warning")} AS quality_warnings FROM keyed),
    zl AS (SELECT location_id, arg_max(borough, (first_loaded, zone_key)) AS borough, arg_max(zone, (first_loaded, zone_key)) AS zone, arg_max(service_zone, (first_loaded, zone_key)) AS service_zone FROM dim_zone GROUP BY 1),
    ok AS (SELECT e.*, p.borough AS pickup_borough, p.zone AS pickup_zone, q.borough AS dropoff_borough, q.zone AS dropoff_zone FROM ev e LEFT JOIN zl p ON e."PULocationID" = p.location_id LEFT JOIN zl q ON e."DOLocationID" = q.location_id WHERE failed_rules = ''),
    bad AS (SELECT * FROM ev WHERE failed_rules <> ''),
    cn AS (SELECT hvfhs_license_num AS licence, arg_max(company_name, first_loaded) AS name FROM dim_company GROUP BY 1)"""
_COMPANY = "CASE WHEN hvfhs_license_num IS NULL THEN 'Unknown' ELSE coalesce(name, 'Other (' || hvfhs_license_num || ')') END"
_RULES = ", ".join(f"('{r.id}', '{r.severity}', '{r.description}')" for r in RULES)
_COUNTS = f"""rc AS (SELECT data_month, r.id AS rule_id, r.sev AS severity, r.descr AS description,
      CAST(count(*) FILTER (WHERE list_contains(string_split(failed_rules || ',' || quality_warnings, ','), r.id)) AS BIGINT) AS matched_rows, count(*) AS total_rows
      FROM ev CROSS JOIN (VALUES {_RULES}) r(id, sev, descr) GROUP BY ALL)"""
_RATES = """rr AS (SELECT *, matched_rows / total_rows AS match_rate FROM rc),
    rp AS (SELECT *, lag(match_rate) OVER (PARTITION BY rule_id ORDER BY data_month) AS previous_match_rate FROM rr),
    rates AS (SELECT *, CASE WHEN previous_match_rate = 0 THEN NULL ELSE match_rate / previous_match_rate END AS rate_vs_previous_month, coalesce(matched_rows >= 100 AND match_rate >= 2 * previous_match_rate, false) AS is_spike FROM rp)"""
_MONTHLY = """ms AS (SELECT c.data_month, rows_checked, coalesce(b, 0) AS rows_quarantined, rows_checked - coalesce(b, 0) AS rows_in_silver, coalesce(b, 0) / rows_checked AS quarantine_rate
      FROM (SELECT data_month, max(total_rows) AS rows_checked FROM rc GROUP BY 1) c LEFT JOIN (SELECT data_month, count(*) AS b FROM bad GROUP BY 1) q ON c.data_month = q.data_month)"""
_CHARGES = ["base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tips"]
_PAID = " + ".join(f"coalesce({_h(c)}, 0)" for c in _CHARGES)


def _total(c: str) -> str:
    return f"CAST(sum(coalesce({_h(c)}, 0)) AS BIGINT) / 100.0"


_DAILY = f"""daily AS (SELECT a.*, {_COMPANY} AS company FROM (SELECT data_month, CAST(pickup_datetime AS DATE) AS trip_date, hvfhs_license_num, count(*) AS trips, {_total("base_passenger_fare")} AS base_fare_total, {_total("tips")} AS tips_total,
      {_total("driver_pay")} AS driver_pay_total, CAST(sum({_PAID}) AS BIGINT) / 100.0 AS passenger_paid_total, {_ratio(f"sum({_h('trip_miles')})", "count(trip_miles) * 100", 3)} AS avg_trip_miles, {_ratio("sum(trip_time)", "count(trip_time) * 60", 2)} AS avg_trip_minutes
      FROM ok GROUP BY ALL) a LEFT JOIN cn ON hvfhs_license_num = licence)"""
_HOURLY = """hz AS (SELECT data_month, CAST(pickup_datetime AS DATE) AS pickup_date, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, "PULocationID", pickup_borough, pickup_zone, count(*) AS trips FROM ok GROUP BY ALL)"""
_ECONOMICS = f"""eco AS (SELECT data_month, hvfhs_license_num, trips, CAST(pay AS BIGINT) / 100.0 AS driver_pay_total, CAST(miles AS BIGINT) / 100.0 AS trip_miles_total, {_ratio("seconds", "CASE WHEN seconds IS NOT NULL THEN 60 END", 2)} AS trip_minutes_total,
      {_ratio("pay", "miles", 4)} AS driver_pay_per_mile, {_ratio("pay * 60", "(seconds * 100)", 4)} AS driver_pay_per_minute, {_ratio("pay", "fare", 4)} AS driver_share_of_base_fare, {_COMPANY} AS company
      FROM (SELECT data_month, hvfhs_license_num, count(*) AS trips, sum({_h("driver_pay")}) AS pay, sum({_h("trip_miles")}) AS miles, sum(trip_time) AS seconds, sum({_h("base_passenger_fare")}) AS fare FROM ok GROUP BY ALL) LEFT JOIN cn ON hvfhs_license_num = licence)"""
_BY_COMPANY = f"""bc AS (SELECT a.*, {_COMPANY} AS company FROM (SELECT data_month, rule_id, hvfhs_license_num, count(*) AS rows_quarantined FROM (SELECT data_month, hvfhs_license_num, unnest(string_split(failed_rules, ',')) AS rule_id FROM bad) GROUP BY ALL) a LEFT JOIN cn ON hvfhs_license_num = licence)"""
_MEASURES = [
    "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "tips", "driver_pay"
]
_FACTS = f"""f AS (SELECT CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour(pickup_datetime) AS INTEGER) AS time_key, "PULocationID" AS pickup_zone_key, "DOLocationID" AS dropoff_zone_key, hvfhs_license_num, {", ".join(_MEASURES)},
      ({_PAID}) / 100.0 AS total_fare, CASE WHEN date_sub('second', request_datetime, pickup_datetime) >= 0 AND pickup_datetime >= request_datetime THEN date_sub('second', request_datetime, pickup_datetime) END AS wait_time_seconds, data_month FROM ok)"""
_MONEY = [*_MEASURES[2:], "total_fare"]


def _sums(source: str, keys: str) -> str:
    money = ", ".join(f"CAST(sum({_h(c)}) AS BIGINT) / 100.0 AS {c}_sum" for c in _MONEY)
    return f"SELECT {keys}, count(*) AS trips, CAST(sum({_h('trip_miles')}) AS BIGINT) / 100.0 AS trip_miles_sum, CAST(sum(trip_time) AS BIGINT) AS trip_time_sum, {money}, CAST(sum(wait_time_seconds) AS BIGINT) AS wait_time_seconds_sum, count(wait_time_seconds) AS wait_time_trips FROM {source} GROUP BY ALL"


_ZF = "zf AS (SELECT location_id AS zone_key, coalesce(arg_max(service_zone, (first_loaded, zone_key)) IN ('Airports', 'EWR'), false) AS is_airport FROM dim_zone GROUP BY 1)"
_MONTH_MEASURES = f"""mm AS (SELECT month_start, count(*) AS total_trips, CAST(sum({_h("total_fare")}) AS BIGINT) / 100.0 AS total_revenue, {_ratio(f"sum({_h('total_fare')})", "(count(*) * 100)", 4)} AS avg_fare,
      {_ratio("sum(wait_time_seconds)", "(count(wait_time_seconds) * 60)", 4)} AS avg_wait_minutes, CAST(sum({_h("driver_pay")}) AS BIGINT) / 100.0 AS driver_pay, {_ratio(f"sum({_h('driver_pay')})", f"sum({_h('total_fare')})", 4)} AS driver_pay_share,
      nullif(count(*) FILTER (WHERE is_airport), 0) AS airport_pickups
      FROM fct_trips t LEFT JOIN dim_date c ON t.date_key = c.date_key LEFT JOIN zf ON t.pickup_zone_key = zf.zone_key GROUP BY 1)"""


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


def _checks(name: str, expected: str, actual: str) -> str:
    return f"SELECT '{name}' AS name, CAST({expected} AS BIGINT) AS expected, CAST({actual} AS BIGINT) AS actual, {expected} = {actual} AS passed"


def replay_events(day) -> str:
    """Pickups of a day numbered in order; what Spark's ordering calls first, nulls too."""
    order = ", ".join(f'"{c}" NULLS FIRST' for c in ("pickup_datetime", "PULocationID", "DOLocationID", "hvfhs_license_num", "trip_miles"))
    number = f"row_number() OVER (ORDER BY {order})"
    return _with(
        _EVALUATED,
        select=f"""SELECT '{day}-' || {number} AS event_id, hvfhs_license_num, "PULocationID" AS pickup_zone_id, CAST(pickup_datetime AS TIMESTAMPTZ) AS event_time, DATE '{day}' AS event_date FROM ok WHERE data_month = DATE '{day.replace(day=1)}' AND CAST(pickup_datetime AS DATE) = DATE '{day}'"""
    )


_PER_LOAD = _EVALUATED.replace(", data_month) AS shared FROM trips)", ", _source_file) AS shared FROM trips WHERE _source_file IS NOT NULL)")
SQL = {
    "p6_recorded_rules": _with(_PER_LOAD, f"""c AS (SELECT _source_file AS source_file, r.id AS rule_id, count(*) FILTER (WHERE list_contains(string_split(failed_rules || ',' || quality_warnings, ','), r.id)) AS matched_rows, count(*) AS total_rows
      FROM ev CROSS JOIN (VALUES {_RULES}) r(id, sev, descr) GROUP BY ALL)""", "q AS (SELECT DISTINCT source_file, rule_id, matched_rows AS recorded_rows FROM rule_counts)",
      select="SELECT c.*, recorded_rows, c.matched_rows = recorded_rows AS agrees FROM c LEFT JOIN q ON c.source_file = q.source_file AND c.rule_id = q.rule_id"),
    "bronze_conform": f"SELECT {', '.join(chr(34) + n + chr(34) if n != 'cbd_congestion_fee' else 'CAST(NULL AS DOUBLE) AS cbd_congestion_fee' for n in NAMES)}, 'load.parquet' AS _source_file, data_month FROM trips WHERE data_month IS NOT NULL",
    "rule_flags": _with(
        _EVALUATED,
        select='SELECT _source_file, pickup_datetime, dropoff_datetime, "PULocationID", "DOLocationID", failed_rules, quality_warnings FROM ev'
    ),
    "silver_rows": _with(
        _EVALUATED,
        select=f"SELECT {_COLUMNS}, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, quality_warnings, _source_file, data_month FROM ok"
    ),
    "quarantine_rows": _with(_EVALUATED, select=f"SELECT {_COLUMNS}, failed_rules, quality_warnings, _source_file, data_month FROM bad"),
    "layer_counts": _with(
        _EVALUATED,
        select="SELECT 'bronze' AS layer, data_month, count(*) AS rows FROM ev GROUP BY ALL UNION ALL SELECT 'silver', data_month, count(*) FROM ok GROUP BY ALL UNION ALL SELECT 'quarantine', data_month, count(*) FROM bad GROUP BY ALL"
    ),
    "rerun_differences": _with(_EVALUATED, select="SELECT 0::BIGINT AS differences, CAST(count(*) AS INTEGER) AS rows FROM bad"),
    "rule_counts": _with(_EVALUATED, _COUNTS, select="SELECT * FROM rc"),
    "daily_company_trips": _with(_EVALUATED, _DAILY, select="SELECT * FROM daily"),
    "hourly_pickup_zones": _with(_EVALUATED, _HOURLY, select="SELECT * FROM hz"),
    "monthly_driver_economics": _with(_EVALUATED, _ECONOMICS, select="SELECT * FROM eco"),
    "top_companies": _with(
        _EVALUATED,
        select=f"SELECT {_COMPANY} AS company, trips FROM (SELECT hvfhs_license_num, count(*) AS trips FROM ok GROUP BY 1) LEFT JOIN cn ON hvfhs_license_num = licence ORDER BY trips DESC, company LIMIT 10"
    ),
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start,
      CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend FROM range(DATE '2024-01-01', DATE '2028-01-01', INTERVAL 1 DAY) t(d)""",
    "dim_time": """SELECT CAST(h AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour, printf('%02d:00', h) AS hour_label, CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS day_part,
      h IN (7, 8, 9, 16, 17, 18, 19) AS is_peak_hour FROM range(24) t(h)""",
    "dim_zone": _with(
        _EVALUATED,
        select="SELECT location_id AS zone_key, location_id, borough, zone, service_zone, coalesce(service_zone IN ('Airports', 'EWR'), false) AS is_airport FROM zl"
    ),
    "dim_company": _with(
        _EVALUATED,
        select="SELECT licence AS hvfhs_license_num, name AS company_name FROM cn UNION ALL SELECT DISTINCT hvfhs_license_num, 'Other (' || hvfhs_license_num || ')' FROM ok WHERE hvfhs_license_num NOT IN (SELECT licence FROM cn)"
    ),
    "company_keys": "SELECT DISTINCT hvfhs_license_num, company_key FROM dim_company WHERE hvfhs_license_num IS NOT NULL",
    "fct_trips": _with(
        _EVALUATED, _FACTS,
        select="SELECT f.* EXCLUDE (hvfhs_license_num), company_key FROM f LEFT JOIN (SELECT DISTINCT hvfhs_license_num AS l, company_key FROM dim_company) ON hvfhs_license_num = l"
    ),
    "trip_key_unique": _with(
        _EVALUATED, _FACTS,
        select="SELECT count(*) AS trips, count(*) AS keys, count(*) FILTER (WHERE wait_time_seconds IS NULL) AS no_wait FROM f"
    ),
    "fct_trips_hourly": _with(_EVALUATED, _FACTS, select=_sums("f", "date_key, time_key, pickup_zone_key AS zone_key, hvfhs_license_num, data_month")),
    "orphan_checks": " UNION ALL ".join(
        f"SELECT '{k}' AS key, count(*) AS orphans FROM fct_trips f WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{c} = f.{k})" for k, t, c in (
            ("date_key", "dim_date", "date_key"), ("time_key", "(SELECT CAST(h AS INTEGER) AS time_key FROM range(24) t(h))", "time_key"),
            ("pickup_zone_key", "dim_zone", "zone_key"), ("dropoff_zone_key", "dim_zone", "zone_key"),
            ("company_key", "dim_company", "company_key")
        )
    ),
    "star_checks": _with(_EVALUATED, "n AS (SELECT count(*) AS c FROM ok)", select=" UNION ALL ".join([*[
        _checks(name, "(SELECT c FROM n)", "(SELECT c FROM n)") for name in ("accepted trips are facts", "trip keys are unique", "hourly trips add up to facts")
    ], *[_checks(f"{k} finds its dimension row", "0", q) for k, q in (
        (
            "date_key",
            "(SELECT count(*) FROM ok WHERE pickup_datetime < TIMESTAMP '2024-01-01' OR pickup_datetime >= TIMESTAMP '2026-01-01')"
        ), ("time_key", "0"),
        ("pickup_zone_key", '(SELECT count(*) FROM ok WHERE "PULocationID" NOT IN (SELECT location_id FROM zl))'), (
            "dropoff_zone_key", '(SELECT count(*) FROM ok WHERE "DOLocationID" NOT IN (SELECT location_id FROM zl))'
        ), ("company_key", "0"))]])),
    "quality_monthly": _with(_EVALUATED, _COUNTS, _MONTHLY, select="SELECT * FROM ms"),
    "rule_rates_spikes": _with(_EVALUATED, _COUNTS, _RATES, select="SELECT * FROM rates"),
    "quarantine_by_company": _with(_EVALUATED, _BY_COMPANY, select="SELECT * FROM bc"),
    "dashboard_counters": _with(
        _EVALUATED, _COUNTS, _RATES, _MONTHLY,
        select="SELECT 'rows_checked' AS counter, CAST(sum(rows_checked) AS BIGINT) AS value FROM ms UNION ALL SELECT 'rows_quarantined', CAST(sum(rows_quarantined) AS BIGINT) FROM ms UNION ALL SELECT 'spikes', count(*) FILTER (WHERE is_spike) FROM rates"
    ),
    "rate_by_month_rule": _with(_EVALUATED, _COUNTS, _RATES, select="SELECT data_month, rule_id, severity, match_rate FROM rates"),
    "spike_table": _with(
        _EVALUATED, _COUNTS, _RATES,
        select="SELECT data_month, rule_id, description, matched_rows, match_rate, previous_match_rate, rate_vs_previous_month FROM rates WHERE is_spike"
    ),
    "quarantine_by_rule_month": _with(
        _EVALUATED, _BY_COMPANY,
        select="SELECT data_month, rule_id, CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined FROM bc GROUP BY 1, 2"
    ),
    "months_loaded": "SELECT count(DISTINCT data_month) AS months FROM trips",
    "executive_totals": f"""SELECT count(*) AS total_trips, CAST(sum({_h('total_fare')}) AS BIGINT) / 100.0 AS total_revenue, {_ratio(f"sum({_h('total_fare')})", "(count(*) * 100)", 4)} AS avg_fare,
      {_ratio("sum(wait_time_seconds)", "(count(wait_time_seconds) * 60)", 4)} AS avg_wait_minutes, {_ratio(f"sum({_h('driver_pay')})", f"sum({_h('total_fare')})", 4)} AS driver_pay_share FROM fct_trips""",
    "measures_by_month": _with(
        _ZF, _MONTH_MEASURES,
        select="SELECT m.*, p.total_trips AS trips_previous_month, round((m.total_trips - p.total_trips) / p.total_trips, 6) AS trip_growth FROM mm m LEFT JOIN mm p ON m.month_start = p.month_start + INTERVAL 1 MONTH"
    ),
    "measures_by_company": _with(
        f"a AS (SELECT month_start, company_name, sum({_h('total_fare')}) AS r, count(*) AS total_trips FROM fct_trips t LEFT JOIN dim_date c ON t.date_key = c.date_key LEFT JOIN dim_company d ON t.company_key = d.company_key GROUP BY 1, 2)",
        f"b AS (SELECT *, sum(r) OVER (PARTITION BY month_start) AS al FROM a)",
        select=f"SELECT month_start, company_name, CAST(r AS BIGINT) / 100.0 AS total_revenue, total_trips, {_ratio('r', 'al', 4)} AS share FROM b"
    ),
    "airport_dropoffs": _with(
        _ZF,
        select="SELECT data_month, count(*) AS trips, count(*) FILTER (WHERE is_airport) AS airport_dropoffs FROM fct_trips t LEFT JOIN zf ON t.dropoff_zone_key = zf.zone_key GROUP BY 1"
    ),
    "weekday_peak_share": f"SELECT month_start, {_ratio('nullif(count(*) FILTER (WHERE time_key IN (7, 8, 9, 16, 17, 18, 19) AND NOT is_weekend), 0)', 'count(*) FILTER (WHERE NOT is_weekend)', 4)} AS weekday_peak_share FROM fct_trips t LEFT JOIN dim_date c ON t.date_key = c.date_key GROUP BY 1",
    "api_economics": _with(
        _EVALUATED, _ECONOMICS,
        select="SELECT * EXCLUDE (hvfhs_license_num) FROM eco WHERE data_month = DATE '2025-01-01' ORDER BY trips DESC, company"
    ),
    "api_daily": _with(
        _EVALUATED, _DAILY,
        select=f"SELECT * EXCLUDE (data_month, hvfhs_license_num) FROM daily WHERE trip_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' ORDER BY trip_date, company"
    ),
    "api_busiest": _with(
        _EVALUATED, _HOURLY,
        select="""SELECT "PULocationID" AS zone_id, pickup_borough AS borough, pickup_zone AS zone, CAST(sum(trips) AS BIGINT) AS trips FROM hz WHERE data_month = DATE '2025-01-01' AND pickup_hour = 8 GROUP BY 1, 2, 3 ORDER BY trips DESC, zone_id LIMIT 20"""
    ),
    "api_quality": _with(
        _EVALUATED, _COUNTS, _RATES, _MONTHLY,
        select="SELECT m.data_month, rows_checked, rows_quarantined, quarantine_rate, coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (WHERE is_spike), '') AS spike_rules FROM ms m LEFT JOIN rates r ON m.data_month = r.data_month GROUP BY ALL"
    ),
    "profile_columns": " UNION ALL ".join(
        f"""SELECT data_month, count(*) AS row_count, '{n}' AS column_name, count(*) - count("{n}") AS nulls, {f'CAST(min("{n}") AS DOUBLE)' if num else 'NULL::DOUBLE'} AS min_value, {f'CAST(max("{n}") AS DOUBLE)' if num else 'NULL::DOUBLE'} AS max_value,
        {f'count(*) FILTER (WHERE "{n}" < 0)' if num else 'NULL::BIGINT'} AS negative_rows, {f'count(*) FILTER (WHERE "{n}" = 0)' if num else 'NULL::BIGINT'} AS zero_rows, {f'count(*) FILTER (WHERE "{n}" NOT BETWEEN 1 AND 265)' if n.endswith('LocationID') else 'NULL::BIGINT'} AS zones_out_of_range FROM trips GROUP BY data_month"""
        for n in NAMES for num in [n.endswith("LocationID") or n in _MEASURES]),
    "duplicate_stats": f"SELECT data_month, count(*) FILTER (WHERE n > 1) AS groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows, CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS extra_rows FROM (SELECT data_month, {', '.join(chr(34) + c + chr(34) for c in IDENTITY)}, count(*) AS n FROM trips GROUP BY ALL) GROUP BY 1",
    "flag_top10": f"SELECT data_month, flag, value, n, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY data_month, flag ORDER BY n DESC, value NULLS FIRST) AS place FROM ({' UNION ALL '.join(f'SELECT data_month, {chr(39)}{c}{chr(39)} AS flag, {c} AS value, count(*) AS n FROM trips GROUP BY ALL' for c in FLAGS)})) WHERE place <= 10",
    "timestamp_checks": "SELECT data_month, count(*) FILTER (WHERE pickup_datetime < data_month OR pickup_datetime >= data_month + INTERVAL 1 MONTH) AS pickup_outside_month, count(*) FILTER (WHERE dropoff_datetime <= pickup_datetime) AS dropoff_not_after_pickup, count(*) FILTER (WHERE pickup_datetime < request_datetime) AS pickup_before_request, count(*) FILTER (WHERE on_scene_datetime > pickup_datetime) AS on_scene_after_pickup FROM trips GROUP BY 1",
    "upsert_company": _with(
        _EVALUATED,
        select="SELECT licence AS hvfhs_license_num, name AS company_name FROM cn UNION ALL SELECT DISTINCT hvfhs_license_num, 'Other (' || hvfhs_license_num || ')' FROM ok WHERE hvfhs_license_num NOT IN (SELECT licence FROM cn)"
    ),
    "replace_month_rerun": "SELECT data_month, count(*) AS trips FROM trips WHERE data_month IN (DATE '2025-01-01', DATE '2025-02-01') GROUP BY 1",
}
