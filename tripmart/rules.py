"""Quality rules as data, and their evaluation on a layer of trips in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint

REJECT, WARNING = "reject", "warning"
REQUIRED = (
    "hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
    "base_passenger_fare", "driver_pay"
)
#: Rows that agree in these columns may be one trip reported twice.
IDENTITY = ("hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID")
SHARED = "__identity_rows"


@dataclass(frozen=True)
class Rule:
    id: str
    severity: str
    description: str
    violated: str


#: Ids, severities and conditions; a condition that is null is not violated.
RULES = (
    Rule("Q001", REJECT, "Required value missing", " OR ".join(f"{c} IS NULL" for c in REQUIRED)),
    Rule("Q002", REJECT, "Pickup outside the data month", "pickup_datetime < data_month OR pickup_datetime >= add_months(data_month, 1)"),
    Rule("Q003", REJECT, "Drop-off not after pickup", "dropoff_datetime <= pickup_datetime"),
    Rule("Q004", REJECT, "Negative base fare", "base_passenger_fare < 0"),
    Rule("Q005", REJECT, "Negative driver pay", "driver_pay < 0"),
    Rule("Q006", REJECT, "Negative distance or duration", "trip_miles < 0 OR trip_time < 0"),
    Rule("Q007", REJECT, "Zone out of range", "NOT (PULocationID BETWEEN 1 AND 265) OR NOT (DOLocationID BETWEEN 1 AND 265)"),
    Rule("W001", WARNING, "Pickup before request", "pickup_datetime < request_datetime"),
    Rule("W002", WARNING, "No distance", "trip_miles = 0"),
    Rule("W003", WARNING, "No base fare", "base_passenger_fare = 0"),
    Rule("W004", WARNING, "Trip over six hours", "trip_time > 21600"),
    Rule("W005", WARNING, "Candidate key shared", f"{SHARED} > 1"),
)


def with_shared_identity(trips: DataFrame, *, within: Sequence[str] = ("data_month",), broadcast_keys: int = 100_000) -> DataFrame:
    """Trips with the number of rows of their month that have the same identity (nulls are equal).

    Only the identity columns are shuffled to count; the few identities held by several rows are joined back,
    broadcast while there are at most ``broadcast_keys``, so the wide rows stay where they are.
    """
    keys = [*IDENTITY, *within]
    several = trips.groupBy(*keys).agg(F.count(F.lit(1)).alias(SHARED)).where(F.col(SHARED) > 1)
    several = checkpoint(several.select(*[F.col(k).alias(f"__{k}") for k in keys], SHARED))  # counted and joined, made once
    if several.count() <= broadcast_keys:
        several = F.broadcast(several)
    same = [trips[k].eqNullSafe(several[f"__{k}"]) for k in keys]
    return trips.join(several, same, "left").drop(*[f"__{k}" for k in keys]).withColumn(SHARED, F.coalesce(SHARED, F.lit(1).cast("bigint")))


def _matched(severity: str, rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(F.expr(r.violated), F.lit(False)), F.lit(r.id)) for r in rules if r.severity == severity]))


def evaluate(trips: DataFrame, rules: Sequence[Rule] = RULES, *, within: Sequence[str] = ("data_month",)) -> DataFrame:
    """Trips with ``failed_rules`` and ``quality_warnings``, ids in the order of the rules; identities are shared ``within`` a month or load."""
    return with_shared_identity(trips, within=within).withColumns(
        {"failed_rules": _matched(REJECT, rules), "quality_warnings": _matched(WARNING, rules)}
    ).drop(SHARED)


def counts(evaluated: DataFrame, by: Sequence[str] = ("data_month",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows matched by each rule, all rules of a group in one pass: always as many rows as there are rules."""
    hit = F.concat("failed_rules", "quality_warnings")
    wide = evaluated.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.array_contains(hit, r.id)).alias(r.id) for r in rules])
    entries = F.array(
        *[
            F.struct(
                F.lit(r.id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.description).alias("description"),
                F.col(r.id).alias("matched_rows")
            ) for r in rules
        ]
    )
    return wide.select(*by, F.inline(entries), "total_rows").select(*by, "rule_id", "severity", "description", "matched_rows", "total_rows")
