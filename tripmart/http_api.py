"""The serving answers over HTTP, from a snapshot's tables: JSON rows, 422 for bad arguments, 404 for months not served."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import pipeline, serving


class Service:
    """The answers by path. Tables are cached: each has a few thousand rows a month, as everything served is aggregated."""

    def __init__(self, spark: SparkSession, snapshot: str):
        read = lambda n: spark.read.parquet(f"{snapshot}/{n}")
        self.tables = {n: read(n).cache() for n in pipeline.SERVED}

    def answer(self, path: str, given: dict[str, str]) -> object:
        economics = self.tables["monthly_driver_economics"]
        routes: dict[str, Callable[[], object]] = {
            "/health": lambda: {"status": "ok", "months": serving.months(economics)},
            "/drivers/economics": lambda: serving.driver_economics(economics, _need(given, "month"), given.get("company")),
            "/trips/daily": lambda: serving.daily_trips(self.tables["daily_company_trips"], _day(given, "start"), _day(given, "end"), given.get("company")),
            "/zones/busiest": lambda: serving.busiest_zones(
                self.tables["hourly_pickup_zones"], economics, _need(given, "month"), _whole(given, "hour", None),
                _whole(given, "limit", 10)
            ),
            "/quality/monthly": lambda: serving.monthly_quality(
                self.tables["quality_months"].withColumn("quarantine_rate", F.try_divide("rows_quarantined", "rows_checked")),
                self.tables["rule_counts"]
            ),
        }
        if path not in routes:
            raise serving.NotServed(f"there is no {path}")
        out = routes[path]()
        return [r.asDict() for r in out.collect()] if isinstance(out, DataFrame) else out

    def respond(self, target: str) -> tuple[int, str]:
        url = urlsplit(target)
        try:
            return 200, json.dumps(self.answer(url.path, {k: v[-1] for k, v in parse_qs(url.query).items()}), default=str)
        except serving.BadRequest as wrong:
            return 422, json.dumps({"detail": str(wrong)})
        except serving.NotServed as gone:
            return 404, json.dumps({"detail": str(gone)})


def _need(given: dict[str, str], name: str) -> str:
    if name not in given:
        raise serving.BadRequest(f"{name} is missing")
    return given[name]


def _day(given: dict[str, str], name: str) -> date:
    try:
        return date.fromisoformat(_need(given, name))
    except ValueError as wrong:
        raise serving.BadRequest(f"{name}: {wrong}") from wrong


def _whole(given: dict[str, str], name: str, default: int | None) -> int | None:
    try:
        return int(given[name]) if name in given else default
    except ValueError as wrong:
        raise serving.BadRequest(f"{name}: {wrong}") from wrong


def server(service: Service, port: int = 0) -> ThreadingHTTPServer:
    """A server of the machine itself; requests run side by side in one Spark session."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body = service.respond(self.path)
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
