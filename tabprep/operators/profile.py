"""Profiles of a table: class sizes, summaries, boxes, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.arrays import elements
from tabprep.operators.joins import not_in
from tabprep.operators.prefix import unpivot
from tabprep.operators.quantiles import exact_quantiles


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``, most frequent first."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label)


def class_count_profile(df: DataFrame, label: str) -> DataFrame:
    """One row over the class sizes: largest, smallest and median, with the classes' names."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    median = exact_quantiles(counts, ["n"], [0.5]).select("q0").scalar()
    return counts.agg(
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("largest"),
        F.max("n").alias("largest_n"),
        F.min_by(label, F.struct(F.col("n"), F.col(label))).alias("smallest"),
        F.min("n").alias("smallest_n"),
    ).withColumn("median_n", median)


def class_tail_flag(df: DataFrame, label: str, under: int = 100) -> DataFrame:
    """Class sizes with a mark on classes of fewer than ``under`` rows."""
    return class_counts(df, label).withColumn("tail", F.col("n") < under)


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, exact quantiles, max."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(F.col(c)).cast("double").alias("min"),
            F.max(F.col(c)).cast("double").alias("max"),
        )
        for c in cols
    ]
    basic = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    names = {f"q{i}": f"p{round(p * 100)}" for i, p in enumerate(probs)}
    cuts = exact_quantiles(df, cols, probs).drop("n").withColumnsRenamed(names)
    return basic.join(cuts, "column", "left")


def trust_threshold(df: DataFrame, score: str) -> DataFrame:
    """Add ``threshold`` = mean - deviation / 2 of the score and the flag ``trusted``."""
    bound = df.agg(F.avg(score) - F.stddev_samp(score) / 2).scalar()
    return df.withColumn("threshold", bound).withColumn("trusted", F.col(score) >= F.col("threshold"))


def language_counts(df: DataFrame, lang: str, unknown: str = "unknown") -> DataFrame:
    """``(language, n, failed)``: rows per language, and which row counts the failures."""
    counts = df.groupBy(F.col(lang).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("failed", F.col("language") == unknown).orderBy(F.desc("n"), "language")


def augmentation_delta(
    original: DataFrame, augmented: DataFrame, column: str, key: str | None = None
) -> DataFrame:
    """One row: original rows, augmented rows, augmented rows whose text is new.

    ``key`` is a row key of the augmented table, see :func:`tabprep.operators.joins.not_in`.
    """
    new = not_in(augmented, original, column, key)
    return original.agg(F.count(F.lit(1)).alias("original_rows")).select(
        "original_rows",
        augmented.agg(F.count(F.lit(1))).scalar().alias("augmented_rows"),
        new.agg(F.count(F.lit(1))).scalar().alias("new_rows"),
    )


def box_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Box-plot numbers per column: quartiles, whiskers at the last points within 1.5 IQR, outliers."""
    quartiles = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    values = unpivot(df, cols).filter(F.col("value").isNotNull())
    # one row per profiled column
    fenced = values.join(F.broadcast(quartiles), "column")
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    inside = F.col("value").between(F.col("q0") - reach, F.col("q2") + reach)
    return fenced.groupBy("column").agg(
        F.max("q0").alias("q1"),
        F.max("q1").alias("median"),
        F.max("q2").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, lo, hi, n)``: equal-width bins over the range, the last one closed."""
    x = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    flat = ends["lo"] == ends["hi"]
    lo = F.when(flat, ends["lo"] - 0.5).otherwise(ends["lo"])
    hi = F.when(flat, ends["hi"] + 0.5).otherwise(ends["hi"])
    at = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lo"),
        (lo + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


#: Terms of the expansion, and the reach of a box in units of sqrt(2) * bandwidth, beyond which a kernel is below 1e-18.
TERMS, REACH = 16, 6.5


def density(df: DataFrame, column: str, points: int = 200, reach: float = 0.0) -> DataFrame:
    """``(point, x, density)``: Gaussian kernel density on a grid, bandwidth n^(-1/5) * deviation.

    Fast Gauss transform (Greengard and Strain, "The fast Gauss transform", 1991): values fall into boxes of
    width bandwidth / sqrt(2), a box keeps ``TERMS`` moments of its values about its middle, and a grid point adds the
    Hermite series of the boxes near it. In units of sqrt(2) * bandwidth a value is at most 1/4 from
    its middle, so by Cramer's inequality the terms left out are below 1e-13 of a kernel's height
    per value, and the density's error is below 1e-9 of that height. One row per box and task is shuffled, however many values there are.

    NULL and NaN are left out. Without a bandwidth (fewer than two values, or all equal) the density is NULL; without values there are no points.
    """
    x = F.col(column).cast("double")
    rows = df.select(x.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    n, deviation, low, high = rows.agg(F.count("v"), F.stddev_samp("v"), F.min("v"), F.max("v")).first()
    grid = df.sparkSession.range(points if n else 0).select(F.col("id").cast("int").alias("point"))
    h = n ** -0.2 * deviation if deviation else 0.0
    start = (low or 0.0) - reach * h
    step = ((high or 0.0) - (low or 0.0) + 2 * reach * h) / (points - 1)
    at = (F.lit(start) + F.col("point") * F.lit(step)).alias("x")
    if not h:
        return grid.select("point", at, F.lit(None).cast("double").alias("density"))
    unit, width = math.sqrt(2) * h, h / math.sqrt(2)
    boxed = rows.withColumn("box", F.floor((F.col("v") - low) / width))
    middle = low + (F.col("box") + 0.5) * width
    t = (F.col("v") - middle) / unit
    # expressions as text: one call to the JVM each
    moments = boxed.withColumn("t", t).groupBy("box").agg(*[F.expr(f"sum(pow(t, {k})) / {math.factorial(k)}D").alias(f"m{k}") for k in range(TERMS)])

    def near(side: int) -> Column:
        return F.least(F.greatest(F.floor((middle + side * REACH * unit - start) / step), F.lit(-1)), F.lit(points - 1)).cast("int")

    # the series as a polynomial per box: coefficients of the Hermite polynomials, by power
    hermite = [[1], [0, 2]]
    for k in range(1, TERMS - 1):
        twice, before = [0, *(2 * c for c in hermite[k])], [2 * k * c for c in hermite[k - 1]] + [0, 0]
        hermite.append([a - b for a, b in zip(twice, before, strict=True)])
    powers = [F.expr(" + ".join(f"m{k} * ({hermite[k][j]}D)" for k in range(j, TERMS, 2))).alias(f"a{j}") for j in range(TERMS)]
    near_points = F.sequence(F.greatest(near(-1), F.lit(0)), F.greatest(near(1), F.lit(0)))
    met = moments.select("box", *powers, F.explode(near_points).alias("point"))
    series = met.withColumn("z", (start + F.col("point") * step - middle) / unit)
    nested = f"a{TERMS - 1}"
    for j in range(TERMS - 2, -1, -1):
        nested = f"({nested} * z + a{j})"
    value = F.expr(f"{nested} * exp(-z * z)")
    sums = series.groupBy("point").agg((F.sum(value) / (n * h * math.sqrt(2 * math.pi))).alias("density"))
    # at most `points` rows
    return grid.join(F.broadcast(sums), "point", "left").select("point", at, F.coalesce("density", F.lit(0.0)).alias("density"))


def channel_counts(df: DataFrame, pixels: Column, channels: int) -> DataFrame:
    """``(channel, value, n)`` over interleaved pixel arrays; raw pixels are never gathered."""
    return (
        elements(df, [], pixels, "value", "i")
        .groupBy((F.col("i") % channels).alias("channel"), "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
