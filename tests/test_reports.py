"""Report formatting matches Python's fixed-point rounding exactly (H4)."""

import random

from pyspark.sql import functions as F

from arquivo.functions.formatting import fixed_point, fixed_point_double


def test_fixed_point_bytes(spark):
    rnd = random.Random(7)
    vals = [0, 1, 2**19, 2**20, 1310720, 3 * 2**18, 5 * 2**18, 2**30 - 1, 163258 * 2**20 + 52429]
    vals += [rnd.randrange(0, 10**12) for _ in range(2000)]
    vals += [k * 2**19 // 10 * 10 for k in range(0, 200)]   # many exact ties of .05 MB
    df = spark.createDataFrame([(v,) for v in vals], "b bigint")
    for pow2, dec in [(20, 1), (30, 1), (30, 2)]:
        got = [r[0] for r in df.select(fixed_point("b", pow2, dec)).collect()]
        exp = [format(v / 2**pow2, f".{dec}f") for v in vals]
        assert got == exp, (pow2, dec)


def test_fixed_point_double(spark):
    rnd = random.Random(11)
    vals = [0.0, 0.005, 0.015, 0.125, 1.005, 1.015, 2.675, 3.125, 6.55, 15.36, 99.995, 1e-9, 123456.785]
    vals += [rnd.uniform(0, 200) for _ in range(3000)]
    vals += [round(rnd.uniform(0, 100), 3) for _ in range(2000)]
    vals += [k / 8 for k in range(0, 800)]                  # exact binary ties
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(fixed_point_double("x", 2)).collect()]
    exp = [format(v, ".2f") for v in vals]
    bad = [(v, g, e) for v, g, e in zip(vals, got, exp) if g != e]
    assert not bad, bad[:5]
    assert df.select(fixed_point_double(F.lit(None).cast("double"), 2)).first()[0] is None


def test_staged_double_formatting(spark):
    from arquivo.functions.formatting import with_fixed_point_double
    vals = [0.0, 0.125, 1.015, 2.675, 3.125, 15.36, 6.55, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in with_fixed_point_double(df, "x", 2, "t").collect()]
    assert got == [None if v is None else format(v, ".2f") for v in vals]
