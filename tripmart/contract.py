"""The trip contract: names and types of the source columns, and bringing a raw load to it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.month import Month


class ContractError(ValueError):
    """A load has columns the contract doesn't know."""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    since: Month | None = None


#: The columns of a trip in their order, with type and, for later ones, first month.
TRIP: tuple[Field, ...] = (
    Field("hvfhs_license_num", "string"),
    Field("dispatching_base_num", "string"),
    Field("originating_base_num", "string"),
    Field("request_datetime", "timestamp_ntz"),
    Field("on_scene_datetime", "timestamp_ntz"),
    Field("pickup_datetime", "timestamp_ntz"),
    Field("dropoff_datetime", "timestamp_ntz"),
    Field("PULocationID", "int"),
    Field("DOLocationID", "int"),
    Field("trip_miles", "double"),
    Field("trip_time", "bigint"),
    Field("base_passenger_fare", "double"),
    Field("tolls", "double"),
    Field("bcf", "double"),
    Field("sales_tax", "double"),
    Field("congestion_surcharge", "double"),
    Field("airport_fee", "double"),
    Field("tips", "double"),
    Field("driver_pay", "double"),
    Field("shared_request_flag", "string"),
    Field("shared_match_flag", "string"),
    Field("access_a_ride_flag", "string"),
    Field("wav_request_flag", "string"),
    Field("wav_match_flag", "string"),
    Field("cbd_congestion_fee", "double", Month.parse("2025-01")),
)
NAMES = [f.name for f in TRIP]
METADATA = (Field("_source_file", "string"), Field("_ingested_at", "timestamp"), Field("data_month", "date"))


def ddl(fields: Iterable[Field]) -> str:
    return ", ".join(f"`{f.name}` {f.kind}" for f in fields)


def schema(fields: Iterable[Field]) -> T.StructType:
    return T.StructType.fromDDL(ddl(fields))


def missing_columns(columns: Sequence[str], contract: Sequence[Field] = TRIP) -> list[str]:
    """Contract columns a load lacks; columns it has beyond the contract stop the load."""
    unknown = sorted(set(columns) - {f.name for f in contract})
    if unknown:
        raise ContractError(f"columns outside the contract: {', '.join(unknown)}")
    return [f.name for f in contract if f.name not in columns]


def conform(
    raw: DataFrame, month: Month | str, source_file: str, ingested_at: datetime | None = None, contract: Sequence[Field] = TRIP
) -> DataFrame:
    """A load in the contract's columns, order and types, with its file, time of loading and month.

    ``month`` is that of the load or, where several are read at once, the column that holds each row's. A column the load
    lacks is null; a value that doesn't fit its type fails the load (ANSI casts).
    """
    absent = set(missing_columns([c for c in raw.columns if c != month], contract))
    columns = [F.lit(None).cast(f.kind).alias(f.name) if f.name in absent else F.col(f"`{f.name}`").cast(f.kind).alias(f.name) for f in contract]
    at = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    of = F.col(month) if isinstance(month, str) else F.lit(month.first)
    return raw.select(*columns, F.lit(source_file).alias("_source_file"), at.alias("_ingested_at"), of.alias("data_month"))
