import math
import random
import struct

from pyspark.sql import functions as F

from tripmart.functions.columns import leading_bits, order_bits


def bits(x):
    (n,) = struct.unpack(">q", struct.pack(">d", x + 0.0))
    return n if n >= 0 else -1 - (n & 0x7FFFFFFFFFFFFFFF)


def test_order_bits_are_those_of_the_doubles(spark):
    rng = random.Random(1)
    values = [math.ldexp(1.0, e) for e in range(-1074, 1024)]
    values += [math.nextafter(v, 0.0) for v in values] + [math.nextafter(v, math.inf) for v in values]
    values += [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(5000)] + [round(rng.lognormvariate(3, 1), 2) for _ in range(2000)] + [0.0, math.inf]
    values = [s * v for v in values if not math.isnan(v) for s in (1, -1)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", order_bits(F.col("v")).alias("b"), leading_bits(F.col("v"), 24).alias("d")
    ).collect()
    assert all(r["b"] == bits(r["v"]) and r["d"] == bits(r["v"]) >> 40 for r in rows)


def test_zero_null_and_nan(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (None,), (float("nan"),), (float("inf"),)], "v double").select(order_bits(F.col("v")).alias("b")).collect()
    got = [r["b"] for r in rows]
    assert got[0] == got[1] == 0 and got[2] is None and got[3] > got[4]
