"""Fixed-width report formatting.

Sizes are shown as bytes / 2^k with one or two decimals. The reference rounds
the exact binary quotient half-to-even; Java's formatter rounds half-up. Since
the divisor is a power of two, the exact rounding is done in integer
arithmetic: no floating point is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.functions.columns import col


def fixed_point(num: Column | str, divisor_pow2: int, decimals: int) -> Column:
    """Text of num / 2**divisor_pow2 with ``decimals`` places, ties to even
    (num >= 0, integral). All steps are exact integer operations."""
    scale = 10 ** decimals
    d = 1 << divisor_pow2
    scaled = col(num).cast("bigint") * F.lit(scale)
    q = F.shiftright(scaled, divisor_pow2)          # floor(scaled / d)
    r = scaled - F.shiftleft(q, divisor_pow2)        # scaled mod d
    half = d // 2
    up = (r > F.lit(half)) | ((r == F.lit(half)) & (F.pmod(q, F.lit(2)) == 1))
    t = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    if decimals == 0:
        return t.cast("string")
    fp = F.pmod(t, F.lit(scale))
    ip = ((t - fp) / F.lit(scale)).cast("bigint")   # exact: t - fp is a multiple of scale
    return F.concat(ip.cast("string"), F.lit("."), F.lpad(fp.cast("string"), decimals, "0"))


def fixed_point_double(x: Column | str, decimals: int) -> Column:
    """Text of a non-negative double with ``decimals`` places, rounded like the
    reference: the exact binary value, ties to even.

    x = M / 2^K exactly, with M an integer of at most 55 bits (scaling by a power
    of two is exact; one spare bit absorbs an off-by-one in log2). The decimal
    rounding of M * 10^d / 2^K is then done with integer shifts."""
    x = col(x)
    scale = 10 ** decimals
    k = (F.lit(53) - F.floor(F.log2(x))).cast("int")
    m = (x * F.pow(F.lit(2.0), k)).cast("bigint")
    num = m * F.lit(scale)
    q = F.call_function("shiftright", num, k)
    r = num - F.call_function("shiftleft", q, k)
    half = F.call_function("shiftleft", F.lit(1).cast("bigint"), k - 1)
    up = (r > half) | ((r == half) & (F.pmod(q, F.lit(2)) == 1))
    t = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    # Values too small to reach half a unit of the last place round to zero;
    # values of 2^52 and more are integers already.
    tiny = x * F.lit(scale) < F.lit(0.25)
    big = x >= F.lit(float(2 ** 52))
    t = F.when(tiny, F.lit(0).cast("bigint")).when(big, x.cast("bigint") * F.lit(scale)).otherwise(t)
    fp = F.pmod(t, F.lit(scale))
    ip = ((t - fp) / F.lit(scale)).cast("bigint")
    text = F.concat(ip.cast("string"), F.lit("."), F.lpad(fp.cast("string"), decimals, "0")) \
        if decimals else t.cast("string")
    return F.when(x.isNull(), F.lit(None)).otherwise(text)


def with_fixed_point_double(df: DataFrame, src: str, decimals: int, out: str) -> DataFrame:
    """``fixed_point_double`` as successive projections, so each intermediate
    (exponent, mantissa, quotient, remainder) is computed once per row."""
    scale = 10 ** decimals
    x = F.col(src)
    t = f"_fp_{out}"
    df = df.withColumn(t + "k", (F.lit(53) - F.floor(F.log2(x))).cast("int"))
    df = df.withColumn(t + "n", (x * F.pow(F.lit(2.0), F.col(t + "k"))).cast("bigint") * F.lit(scale))
    df = df.withColumn(t + "q", F.call_function("shiftright", F.col(t + "n"), F.col(t + "k")))
    k, n, q = F.col(t + "k"), F.col(t + "n"), F.col(t + "q")
    r = n - F.call_function("shiftleft", q, k)
    half = F.call_function("shiftleft", F.lit(1).cast("bigint"), k - 1)
    up = (r > half) | ((r == half) & (F.pmod(q, F.lit(2)) == 1))
    rounded = (
        F.when(x * F.lit(scale) < F.lit(0.25), F.lit(0).cast("bigint"))
        .when(x >= F.lit(float(2 ** 52)), x.cast("bigint") * F.lit(scale))
        .otherwise(q + F.when(up, F.lit(1)).otherwise(F.lit(0)))
    )
    df = df.withColumn(t + "t", rounded)
    tt = F.col(t + "t")
    fp = F.pmod(tt, F.lit(scale))
    text = F.concat(((tt - fp) / F.lit(scale)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad(fp.cast("string"), decimals, "0")) if decimals else tt.cast("string")
    df = df.withColumn(out, F.when(x.isNull(), F.lit(None)).otherwise(text))
    return df.drop(t + "k", t + "n", t + "q", t + "t")


def rjust(text: Column, width: int) -> Column:
    """Right-align in ``width`` (never truncates)."""
    return F.format_string(f"%{width}s", text)


def ljust(text: Column, width: int) -> Column:
    """Left-align in ``width`` (never truncates)."""
    return F.format_string(f"%-{width}s", text)
