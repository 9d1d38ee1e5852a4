"""Sums and ratios in whole hundredths: exact, so independent of the order in which tasks add."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(c: Column) -> Column:
    """An amount of money or miles as a whole number of hundredths."""
    return F.round(c * 100).cast("bigint")


def amount(h: Column) -> Column:
    return h / F.lit(100.0)


def total(name: str) -> Column:
    """Sum of a column, 0 where all of it is null."""
    return amount(F.sum(F.coalesce(hundredths(F.col(name)), F.lit(0).cast("bigint"))))


def total_or_null(name: str) -> Column:
    return amount(F.sum(hundredths(F.col(name))))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole of two whole numbers, half up to ``digits``; null where ``whole`` is not above 0."""
    scale = 10**digits
    number = lambda c: c.cast("decimal(28,0)")
    up = F.floor((F.abs(number(part)) * (2 * scale) + number(whole)) / (number(whole) * 2)).cast("double") * F.signum(part.cast("double"))
    return F.when(whole > 0, up / F.lit(float(scale)))
