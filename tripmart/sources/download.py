"""Fetching monthly files: size check first, a partial file, then an atomic rename."""

from __future__ import annotations

import os
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from tripmart.month import Month

Opener = Callable[[urllib.request.Request], object]


@dataclass(frozen=True)
class Fetched:
    path: Path
    size: int
    skipped: bool


def file_name(dataset: str, month: Month) -> str:
    return f"{dataset}_tripdata_{month}.parquet"


def fetch(url: str, target: Path, opener: Opener = urllib.request.urlopen, chunk: int = 1 << 20) -> Fetched:
    """Bring ``url`` to ``target`` unless a file of the announced size is there already.

    A transfer that ends short of the announced size leaves no file.
    """
    with opener(urllib.request.Request(url, method="HEAD")) as head:
        size = int(head.headers["Content-Length"])
    if target.exists() and target.stat().st_size == size:
        return Fetched(target, size, True)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    with opener(urllib.request.Request(url)) as body, part.open("wb") as out:
        while block := body.read(chunk):
            out.write(block)
    if part.stat().st_size != size:
        got = part.stat().st_size
        part.unlink()
        raise OSError(f"{url}: {got} of {size} bytes came")
    os.replace(part, target)
    return Fetched(target, size, False)


def fetch_month(base_url: str, dataset: str, month: Month, folder: Path, opener: Opener = urllib.request.urlopen) -> Fetched:
    name = file_name(dataset, month)
    return fetch(f"{base_url}/{name}", folder / dataset / name, opener)


#: Fixed value: the name of the zone lookup, at its source and in the data folder.
ZONES = "taxi_zone_lookup.csv"


def fetch_zones(url: str, folder: Path, opener: Opener = urllib.request.urlopen) -> Fetched:
    """The zone lookup, from a folder's address or its own."""
    return fetch(url if url.endswith(".csv") else f"{url}/{ZONES}", folder / ZONES, opener)
