"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def licence(column: str = "hvfhs_license_num") -> Column:
    """A licence code without outer white space, in upper case."""
    return F.upper(F.btrim(F.col(column), F.lit(" \t\n\x0b\f\r")))


def month_text(column: str = "data_month") -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def feed_of(file: Column) -> Column:
    """The feed of a monthly file: what stands between its last underscore and its suffix."""
    return F.regexp_extract(file, r"_([^_.]+)\.[^.]*$", 1)


def order_bits(value: Column) -> Column:
    """A 64-bit integer in the order of the doubles: the IEEE bits, those of negatives reversed.

    -0.0 counts as 0.0; null gives null. NaN sorts last, as in Spark. Exponent and fraction are found by exact
    arithmetic with powers of two, without branches, so the expression stays in generated code and each part is
    computed once.
    """
    x = value.cast("double")
    one = lambda c: c.cast("bigint")
    least, most = F.lit(2.0**-1022), F.lit(1.7976931348623157e308)
    size = F.abs(x)
    normal = F.least(F.greatest(size, least), most)
    # the logarithm may be off by one next to a power of two; the fraction then lies outside [1, 2)
    near = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(normal)).cast("double")))
    scaled = normal * F.pow(F.lit(2.0), -near)
    up, down = (scaled >= 2.0).cast("double"), (scaled < 1.0).cast("double")
    fraction = scaled * (down - up / 2 + 1.0) - 1.0
    bits = F.shiftleft(one(near + up - down + 1023.0), 52) + one(fraction * F.lit(2.0**52))
    # what lies below the normal numbers, infinity and NaN, next to the values they were drawn to
    below = one(F.least(size, least) * F.lit(2.0**537) * F.lit(2.0**537)) - F.lit(1 << 52)
    bits = bits + below + one(size > most) + one(F.isnan(x))
    negative = one(x < 0)
    return bits * (F.lit(1) - negative * 2) - negative


def leading_bits(value: Column, n: int) -> Column:
    """The first ``n`` bits of ``order_bits``: bins of values whose order is that of the values."""
    return F.shiftright(order_bits(value), 64 - n).cast("int")
