"""Flattening of computed arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elements(df: DataFrame, keep: Sequence[str], array: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """``(*keep, pos, name)``: one row per array element; empty and NULL arrays give none.

    ``explode`` makes the optimizer test ``size(array) > 0`` below the projection, which
    computes the array twice (and fails for one made in Python). The outer form does not,
    and its rows for empty arrays are dropped here.
    """
    if pos:
        rows = df.select(*keep, F.posexplode_outer(array).alias(pos, name))
        return rows.filter(F.col(pos).isNotNull())
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
