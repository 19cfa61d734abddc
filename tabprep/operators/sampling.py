"""Exact-size splits and samples by hashed keys.

A split needs only the hash value that separates the first m rows from the rest. It is found
from counts per hash prefix, so the rows themselves are never ordered or shuffled: the split
is a filter that any scan can apply.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.seeded import u32
from tabprep.operators.joins import lookup_join
from tabprep.operators.prefix import with_ordinal
from tabprep.session import cut

_HALF_BITS = 16
# Samples up to this size are taken by a top-n, larger ones by a cut-off filter.
TOP_N = 10_000
SALTS = 32
# Up to this n Spark keeps the first n rows of a window's group on the map side (its default).
WINDOW_N = 1000


def _bucket_of(df: DataFrame, bucket: Column, m: int) -> tuple[int, int]:
    """The bucket that holds the m-th row in bucket order, and the row's place within it."""
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most 2^16 rows
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    row = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") >= m)
        .orderBy("b")
        .first()
    )
    return row["b"], m - (row["upto"] - row["n"])


def first_by_hash(df: DataFrame, key: str, m: int, seed: int, salt: str, n: int | None = None) -> Column:
    """A predicate true for exactly the first ``m`` rows by (hash, key); keys must be unique."""
    n = df.count() if n is None else n
    if m <= 0:
        return F.lit(False)
    if m >= n:
        return F.lit(True)
    h = u32(seed, F.col(key), salt)
    keys = df.select(key, h.alias("h"))
    high, place = _bucket_of(keys, F.shiftright("h", _HALF_BITS), m)
    near = keys.filter(F.shiftright("h", _HALF_BITS) == high)
    low, place = _bucket_of(near, F.col("h").bitwiseAND(F.lit((1 << _HALF_BITS) - 1)), place)
    cut = (high << _HALF_BITS) | low
    # rows that share all 32 bits: about n / 2^32
    last = keys.filter(F.col("h") == cut).orderBy(key).limit(place).agg(F.max(key)).first()[0]
    return (h < cut) | ((h == cut) & (F.col(key) <= F.lit(last)))


def split_fraction(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """Add ``part``: the first floor(n / k) rows in hash order are ``dev``, the rest ``train``."""
    n = df.count()
    dev = first_by_hash(df, key, n // k, seed, "split", n)
    return df.withColumn("part", F.when(dev, "dev").otherwise("train"))


def split_seeded(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part``: ceil(test_size * n) rows are ``test``, the rest ``train``."""
    n = df.count()
    test = first_by_hash(df, key, math.ceil(test_size * n), seed, "split", n)
    return df.withColumn("part", F.when(test, "test").otherwise("train"))


def sample_n(df: DataFrame, key: str, n: int, seed: int, salt: str = "sample") -> DataFrame:
    """Exactly ``n`` rows without replacement."""
    if n <= TOP_N:
        return df.orderBy(u32(seed, F.col(key), salt), key).limit(n)
    return df.filter(first_by_hash(df, key, n, seed, salt))


def sample_per_class(
    df: DataFrame, key: str, label: str, n: int, seed: int, salt: str = "sample"
) -> DataFrame:
    """Exactly ``n`` rows of each class (all rows of smaller classes): those with the smallest hashes, then keys.

    Up to ``WINDOW_N`` rows a class is first thinned to its best ``n`` in each of ``SALTS`` slices, so the last
    step sees at most n * SALTS rows of even the largest class. For more rows, counts of hash digits,
    for all classes at once, give each class's n-th hash, and the sample is a filter.
    """
    drawn = df.withColumn("_h", u32(seed, F.col(key), salt))
    if n > WINDOW_N:
        return _below_cuts(drawn, key, label, n)
    slice_ = F.pmod(F.xxhash64(key), F.lit(SALTS))
    order = ["_h", key]
    thin = drawn.withColumn("_r", F.row_number().over(Window.partitionBy(label, slice_).orderBy(*order)))
    last = thin.filter(F.col("_r") <= n).withColumn(
        "_r", F.row_number().over(Window.partitionBy(label).orderBy(*order))
    )
    return last.filter(F.col("_r") <= n).drop("_h", "_r")


def _below_cuts(drawn: DataFrame, key: str, label: str, n: int) -> DataFrame:
    """Rows of each class up to its n-th hash; only rows that share that hash are ordered."""
    # a struct key also matches the class NULL
    drawn = drawn.withColumn("_g", F.struct(F.col(label).alias("label")))
    high, low = F.shiftright("_h", 16), F.col("_h").bitwiseAND(0xFFFF)

    def reached(counts: DataFrame, wanted: Column | int) -> DataFrame:
        """The digit of each class at which ``wanted`` rows are reached; a class has at most 2**16."""
        run = F.sum("count").over(Window.partitionBy("_g").orderBy("_digit"))
        ran = counts.withColumn("_before", run - F.col("count"))
        return ran.filter((F.col("_before") < wanted) & (F.col("_before") + F.col("count") >= wanted)).drop("count")

    first = cut(reached(drawn.groupBy("_g", high.alias("_digit")).count(), n).withColumnRenamed("_digit", "_high"))
    own = lookup_join(drawn.select("_g", "_h", key), first, "_g", "inner", F.col(key)).filter(high == F.col("_high"))
    digits = own.groupBy("_g", low.alias("_digit"), "_high", F.col("_before").alias("_ahead")).count()
    second = reached(digits, n - F.col("_ahead"))
    cuts = cut(second.select("_g", (F.shiftleft("_high", 16) + F.col("_digit")).alias("_cut"), (n - F.col("_ahead") - F.col("_before")).alias("_left")))
    told = lookup_join(drawn, cuts, "_g", "left", F.col(key))
    below = told.filter(F.col("_cut").isNull() | (F.col("_h") < F.col("_cut"))).drop("_g", "_h", "_cut", "_left")
    ties = told.filter(F.col("_h") == F.col("_cut")).withColumn("_r", F.row_number().over(Window.partitionBy("_g").orderBy(key)))
    return below.unionByName(ties.filter(F.col("_r") <= F.col("_left")).drop("_g", "_h", "_cut", "_left", "_r"))


def mix_by_ratio(sources: Sequence[tuple[DataFrame, float]], key: str, seed: int) -> DataFrame:
    """Stack floor(n1 * ratio) random rows of each source; n1 is the size of the first.

    A source with too few rows is an error.
    """
    counts = [df.count() for df, _ in sources]
    mixed = None
    for no, ((df, ratio), available) in enumerate(zip(sources, counts)):
        m = int(counts[0] * ratio)
        if m > available:
            raise ValueError(f"source {no}: {m} rows wanted, {available} there")
        part = df.filter(first_by_hash(df, key, m, seed, f"mix{no}", available))
        part = part.withColumn("source_no", F.lit(no))
        mixed = part if mixed is None else mixed.unionByName(part)
    return mixed


def shuffle(df: DataFrame, key: str, seed: int, epoch: int = 0) -> DataFrame:
    """Add ``position`` 1..n: a permutation that differs per epoch."""
    drawn = df.withColumn("_h", u32(seed, F.col(key), f"epoch{epoch}"))
    return with_ordinal(drawn, "_h", key, name="position").drop("_h")


def union_all(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Stack tables and number the rows from 0, table by table."""
    tagged = [t.withColumn("_t", F.lit(i)) for i, t in enumerate(tables)]
    stacked = tagged[0]
    for t in tagged[1:]:
        stacked = stacked.unionByName(t)
    numbered = with_ordinal(stacked, "_t", key, name="row")
    return numbered.withColumn("row", F.col("row") - 1).drop("_t")
