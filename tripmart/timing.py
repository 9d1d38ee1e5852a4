"""Timing the steps of a pipeline over repeats, and reading the run history of a job."""

from __future__ import annotations

import json
import statistics
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Spread:
    median: float
    least: float
    most: float

    @classmethod
    def of(cls, values: Iterable[float]) -> Spread:
        v = list(values)
        return cls(statistics.median(v), min(v), max(v))


def measure(steps: Mapping[str, Callable[[], object]], repeats: int = 3, clock: Callable[[], float] = time.perf_counter) -> dict[str, list[float]]:
    """Seconds of each step in each repeat, steps in order, the total of a repeat as ``total``."""
    if repeats < 1:
        raise ValueError("at least one repeat")
    seconds: dict[str, list[float]] = {n: [] for n in [*steps, "total"]}
    for _ in range(repeats):
        for name, step in steps.items():
            began = clock()
            step()
            seconds[name].append(clock() - began)
        seconds["total"].append(sum(seconds[n][-1] for n in steps))
    return seconds


def throughput(runs: DataFrame) -> DataFrame:
    """Rows per second over the stream runs that read rows and took time."""
    took = F.unix_micros("finished_at") - F.unix_micros("started_at")
    kept = runs.where((F.col("input_rows") > 0) & (took > 0))
    return kept.agg(
        F.count(F.lit(1)).alias("runs"), F.sum("input_rows").alias("rows"), (F.sum(took) / 1e6).alias("seconds"),
        F.try_divide(F.sum("input_rows") * 1e6, F.sum(took)).alias("rows_per_second")
    )


def job_runs(text: str) -> list[dict]:
    """Successful runs of a job's history, a list or an object with ``runs``: id, parameters, seconds per task and in all."""
    data = json.loads(text)
    out = []
    for run in data["runs"] if isinstance(data, dict) else data:
        if run.get("state", {}).get("result_state") != "SUCCESS":
            continue
        tasks = {t["task_key"]: (t["end_time"] - t["start_time"]) / 1000 for t in run.get("tasks", [])}
        out.append(
            {
                "run_id": run["run_id"], "parameters": {p["name"]: p.get("value") for p in run.get("job_parameters", [])}, "tasks": tasks,
                "seconds": (run["end_time"] - run["start_time"]) / 1000
            }
        )
    return out


def report(title: str, seconds: Mapping[str, list[float]]) -> str:
    lines = [f"# {title}", "", "| step | median s | least | most | first |", "|-|-|-|-|-|"]
    for name, values in seconds.items():
        s = Spread.of(values)
        lines.append(f"| {name} | {s.median:.2f} | {s.least:.2f} | {s.most:.2f} | {values[0]:.2f} |")
    return "\n".join(lines) + "\n"


def throughput_report(runs: DataFrame) -> str:
    """The stream's part of a benchmark report."""
    r = throughput(runs).first()
    if not r["runs"]:
        return "No stream run has read rows.\n"
    return f"## Stream\n\n| runs | rows | seconds | rows a second |\n|-|-|-|-|\n| {r['runs']} | {r['rows']:,} | {r['seconds']:.1f} | {r['rows_per_second']:,.0f} |\n"


def job_report(runs: list[dict]) -> str:
    """Seconds of the tasks of a job over its successful runs, and every run."""
    if not runs:
        return "# Job\n\nNo successful run.\n"
    tasks = list(dict.fromkeys(t for r in runs for t in r["tasks"]))
    seconds = {t: [r["tasks"][t] for r in runs if t in r["tasks"]] for t in tasks} | {"whole job": [r["seconds"] for r in runs]}
    lines = [report("Job", seconds), "| run | parameters | " + " | ".join(tasks) + " | whole |", "|-|-|" + "-|" * (len(tasks) + 1)]
    for r in runs:
        given = ", ".join(f"{k} = {v}" for k, v in r["parameters"].items())
        lines.append(
            f"| {r['run_id']} | {given} | " + " | ".join(f"{r['tasks'][t]:.1f}" if t in r["tasks"] else "" for t in tasks) + f" | {r['seconds']:.1f} |"
        )
    return "\n".join(lines) + "\n"
