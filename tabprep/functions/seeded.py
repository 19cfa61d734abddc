"""Seeded draws that depend on the row key only, never on the partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(seed: int | str, *parts: Column | str) -> Column:
    """Eight hexadecimal digits from the md5 of seed and parts."""
    text = [p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *text)), 1, 8)


def u32(seed: int | str, *parts: Column | str) -> Column:
    """Uniform integer in [0, 2^32) from the md5 of seed and parts.

    Strings among the parts are literals; pass columns with ``F.col``.
    """
    return F.conv(_digits(seed, *parts), 16, 10).cast("bigint")


def u(seed: int | str, *parts: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return u32(seed, *parts) / F.lit(4294967296.0)


def below(p: float, seed: int | str, *parts: Column | str) -> Column:
    """Whether ``u`` of the same seed and parts is below ``p``; digits of one length are ordered as their numbers are."""
    bound = math.ceil(p * 2**32)
    return F.lit(True) if bound >= 2**32 else _digits(seed, *parts) < F.lit(f"{max(bound, 0):08x}")


def pick(n: Column, draw: Column) -> Column:
    """Index 0..n-1 chosen by a draw in [0, 1)."""
    return F.floor(draw * n).cast("int")
