"""Files in any storage Spark can reach: places given as paths or addresses, small texts, moving and removing."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import SparkSession


def located(place: str) -> str:
    """An address stays as it is; a path of this machine becomes absolute."""
    return place if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", place) else str(Path(place).absolute())


def _at(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, place: str) -> bool:
    fs, path = _at(spark, place)
    return fs.exists(path)


def size(spark: SparkSession, place: str) -> int:
    fs, path = _at(spark, place)
    return fs.getFileStatus(path).getLen()


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def remove(spark: SparkSession, place: str) -> None:
    fs, path = _at(spark, place)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a file in the place of another."""
    fs, path = _at(spark, target)
    fs.mkdirs(path.getParent())
    if fs.exists(path):
        fs.delete(path, False)
    if not fs.rename(_at(spark, source)[1], path):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, place: str, text: str) -> None:
    fs, path = _at(spark, place)
    stream = fs.create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, place: str) -> str:
    fs, path = _at(spark, place)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
