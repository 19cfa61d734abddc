"""Exact decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2_exact(x: Column) -> Column:
    """The double nearest to ``x`` printed with two decimals, as C and Python print it.

    Printing rounds the exact binary value, half to even. Spark's ``round`` works on the
    shortest decimal form instead, so 2.675 (stored as 2.67499...) would become 2.68.
    Here ``x`` is scaled by a power of two to an integer and rounded in integer arithmetic.
    """
    a = F.abs(x)
    bits = F.least(F.lit(53) - F.floor(F.log2(a)), F.lit(62)).cast("int")
    scaled = F.floor(a * F.pow(F.lit(2.0), bits)).cast("bigint") * 100
    q = F.call_function("shiftright", scaled, bits)
    rest = scaled - F.call_function("shiftleft", q, bits)
    half = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits - 1)
    up = (rest > half) | ((rest == half) & (q % 2 == 1))
    rounded = F.signum(x) * (q + up.cast("int")) / 100
    return F.when(x == 0, F.lit(0.0)).when(bits < 1, x).otherwise(rounded)
