"""Global order without a single-partition window: ordinals, running sums, exact quantiles.

All three cut the data into value ranges, work inside each range and add the totals of the
ranges before it. Only one row per range and group travels to the offset window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import cut

# Rows of a range, which one task orders.
BUCKET_ROWS = 1_000_000

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_ordinal(df: DataFrame, *order: Column | str, name: str = "ordinal") -> DataFrame:
    """Number the rows 1..n in the given order, which must be unique per row."""
    ranged = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per shuffle partition, so the broadcast is bounded by the partition count
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local + 1)
        .drop("_mid", "_part", "_offset")
    )


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    sums: Sequence[str],
    bucket_rows: int = BUCKET_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Per group, in order: ``<s>_run`` (inclusive), ``<s>_all`` and ``_next`` (following order value).

    Rows must be unique on group and a numeric order, i.e. already aggregated. More than
    ``bucket_rows`` rows are dealt into ranges of (group, order) of about that many, however
    many ranges that makes; they are summed side by side, and the sums of a group's ranges
    before are added afterwards. Where the borders lie does not change the result. ``at_most``
    is a known bound on the rows of ``df`` and saves counting them.
    """
    group = list(group)
    if at_most is None or at_most > bucket_rows:
        df = cut(df)
        rows = df.count()
    else:
        rows = at_most
    if rows <= bucket_rows:
        whole = Window.partitionBy(*group)
        ordered = whole.orderBy(order)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(
            "*",
            *[F.sum(s).over(upto).alias(f"{s}_run") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums],
            F.lead(order).over(ordered).alias("_next"),
        )

    # a struct key also matches groups whose name is NULL
    keyed = df.withColumn("_g", F.struct(*group, F.lit(0).alias("_")))
    ranged = keyed.repartitionByRange(-(-rows // bucket_rows), "_g", order)
    dealt = cut(ranged.withColumn("_part", F.spark_partition_id()))

    local = Window.partitionBy("_g", "_part").orderBy(order)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.select(
        "*",
        *[F.sum(s).over(upto).alias(f"{s}_in") for s in sums],
        F.lead(order).over(local).alias("_next_in"),
    )
    # one row per group and range from here on
    by_part = Window.partitionBy("_g").orderBy("_part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")
    offsets = (
        dealt.groupBy("_g", "_part")
        .agg(*[F.sum(s).alias(f"{s}_p") for s in sums], F.min(order).alias("_first"))
        .select(
            "_g",
            "_part",
            *[F.coalesce(F.sum(f"{s}_p").over(before), F.lit(0)).alias(f"{s}_off") for s in sums],
            *[F.sum(f"{s}_p").over(whole).alias(f"{s}_all") for s in sums],
            F.lead("_first").over(by_part).alias("_next_part"),
        )
    )
    return inside.join(offsets, ["_g", "_part"]).select(
        *df.columns,
        *[(F.col(f"{s}_in") + F.col(f"{s}_off")).alias(f"{s}_run") for s in sums],
        *[F.col(f"{s}_all") for s in sums],
        F.coalesce("_next_in", "_next_part").alias("_next"),
    )


def unpivot(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form ``(*by, column, value DOUBLE)``."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot(list(by), list(cols), "column", "value")


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(*by, column, n, q0..qk)``: exact quantiles with linear interpolation, NULLs left out.

    The data shuffle as (value, count) pairs, so repeated values cost one row each.
    """
    keys = [*by, "column"]
    counted = (
        unpivot(df, cols, by)
        .filter(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_sums(counted, keys, "value", ["n"], bucket_rows)
    first, last = F.col("n_run") - F.col("n"), F.col("n_run") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("value")))

    aggs = [F.max("n_all").alias("n")]
    for i, p in enumerate(probs):
        h = (F.col("n_all") - 1) * F.lit(float(p))
        aggs += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}")]
    found = ranked.groupBy(*keys).agg(*aggs)

    def value(i: int, p: float) -> Column:
        h = (F.col("n") - 1) * F.lit(float(p))
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (h - F.floor(h))

    return found.select(*keys, "n", *[value(i, p).alias(f"q{i}") for i, p in enumerate(probs)])
