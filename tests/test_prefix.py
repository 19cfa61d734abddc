"""Global order, running sums, quantiles, exact samples."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions.numbers import round2_exact
from tabprep.functions.seeded import u
from tabprep.operators import prefix, sampling


def test_with_ordinal_over_many_partitions(spark):
    df = spark.range(5000).repartition(13).select((F.col("id") * 7919 % 5000).alias("k"))
    rows = prefix.with_ordinal(df, F.desc("k")).collect()
    assert sorted(r.ordinal for r in rows) == list(range(1, 5001))
    assert all(r.ordinal == 5000 - r.k for r in rows)


def test_with_ordinal_of_nothing(spark):
    assert prefix.with_ordinal(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("group", [["g"], []])
def test_running_sums_both_ways(spark, group):
    rng = random.Random(1)
    # group 0 holds most rows
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 4), v, rng.randrange(5)) for v in range(3000)]
    df = spark.createDataFrame(rows, "g INT, v INT, n BIGINT")
    small = prefix.running_sums(df, group, "v", ["n"])
    large = prefix.running_sums(df, group, "v", ["n"], bucket_rows=10)
    assert sorted(small.collect()) == sorted(large.select(small.columns).collect())


def test_running_sums_null_group(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5)], "g STRING, v INT, n BIGINT")
    got = {(r.g, r.v): (r.n_run, r.n_all, r._next) for r in prefix.running_sums(df, ["g"], "v", ["n"], 1).collect()}
    assert got == {(None, 1): (2, 5, 2), (None, 2): (5, 5, None), ("a", 1): (5, 5, None)}


@pytest.mark.parametrize("rows", [prefix.BUCKET_ROWS, 5])
def test_exact_quantiles(spark, rows):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 50, 997).astype(float)
    b = rng.normal(size=997)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)] + [(None, None)], "a DOUBLE, b DOUBLE")
    probs = [0, 0.05, 0.25, 0.35, 0.5, 0.95, 1]
    got = {r["column"]: r for r in prefix.exact_quantiles(df, ["a", "b"], probs, bucket_rows=rows).collect()}
    for name, values in (("a", a), ("b", b)):
        assert got[name]["n"] == 997
        want = np.quantile(values, probs)
        assert np.allclose([got[name][f"q{i}"] for i in range(len(probs))], want, atol=1e-12)


def test_exact_quantiles_by_group_and_single_row(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("y", 2.0)], "g STRING, v DOUBLE")
    got = {r.g: r.q0 for r in prefix.exact_quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    assert got == {"x": 1.0, "y": 1.5}


def test_round2_like_printf(spark):
    values = [2.675, 0.125, 0.375, 1.005, -2.675, 2.665, 0.0, 0.005, 0.015, 5.05, 1e-9, 12345.675, 8.0, 1e17]
    rng = random.Random(5)
    values += [rng.randrange(10**7) / 1000 for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(500)]
    values += [rng.randrange(10**6) / 8 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for x, y in df.select("x", round2_exact(F.col("x"))).collect():
        assert y == float(f"{x:.2f}"), x


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    one = {r.id: r.d for r in df.coalesce(1).select("id", u(1, F.col("id"), "a").alias("d")).collect()}
    many = {r.id: r.d for r in df.repartition(9).select("id", u(1, F.col("id"), "a").alias("d")).collect()}
    assert one == many
    assert 0.4 < sum(one.values()) / 500 < 0.6


@pytest.mark.parametrize("m", [0, 1, 7, 333, 1999, 2000, 3000])
def test_first_by_hash_is_exact(spark, m):
    df = spark.range(2000).withColumnRenamed("id", "k")
    got = {r.k for r in df.filter(sampling.first_by_hash(df, "k", m, 5, "s")).collect()}
    ordered = [r.k for r in df.orderBy(sampling.u32(5, F.col("k"), "s"), "k").collect()]
    assert got == set(ordered[:m])


def test_split_parts_are_disjoint_and_complete(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    parts = sampling.split_fraction(df.repartition(5), "k", 10, 1).groupBy("part").count()
    assert {r["part"]: r["count"] for r in parts.collect()} == {"dev": 10, "train": 93}
    seeded = sampling.split_seeded(df, "k").groupBy("part").count()
    assert {r["part"]: r["count"] for r in seeded.collect()} == {"test": 21, "train": 82}


def test_sample_n_above_and_below_the_top_n_limit(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "k")
    small = {r.k for r in sampling.sample_n(df, "k", 60, 9).collect()}
    monkeypatch.setattr(sampling, "TOP_N", 10)
    assert {r.k for r in sampling.sample_n(df, "k", 60, 9).collect()} == small
    assert len(small) == 60


def test_sample_per_class_with_a_hot_class(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") < 2900, "big").otherwise("small").alias("c"))
    got = sampling.sample_per_class(df, "k", "c", 150, 1).groupBy("c").count().collect()
    assert {r.c: r["count"] for r in got} == {"big": 150, "small": 100}


def test_mix_by_ratio_needs_enough_rows(spark):
    a, b = spark.range(100).toDF("k"), spark.range(5).toDF("k")
    with pytest.raises(ValueError):
        sampling.mix_by_ratio([(a, 0.8), (b, 0.2)], "k", 1)
    assert sampling.mix_by_ratio([(a, 0.8), (b, 0.05)], "k", 1).count() == 85


def test_shuffle_differs_per_epoch(spark):
    df = spark.range(200).toDF("k")
    order = lambda e: [r.k for r in sampling.shuffle(df, "k", 1, e).orderBy("position").collect()]
    first, second = order(0), order(1)
    assert first != second and sorted(first) == sorted(second) == list(range(200))


@pytest.mark.parametrize("hashes", [7, 1 << 20, 1 << 32])
def test_class_samples_by_cuts_are_those_by_order(spark, monkeypatch, hashes):
    """Also where rows share hashes, in the class NULL, and in classes of fewer rows."""
    monkeypatch.setattr(sampling, "u32", lambda seed, key, salt: F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(hashes)))
    c = F.when(F.col("k") % 10 < 6, "hot").when(F.col("k") % 10 == 6, F.lit(None)).otherwise((F.col("k") % 40).cast("string"))
    df = spark.range(2000).select(F.col("id").alias("k"), c.alias("c"), F.lit("x").alias("_x"))
    for n in (1, 60, 150, 5000):
        monkeypatch.setattr(sampling, "WINDOW_N", 10_000)
        want = sorted(map(repr, sampling.sample_per_class(df, "k", "c", n, 1).collect()))
        monkeypatch.setattr(sampling, "WINDOW_N", 0)
        assert sorted(map(repr, sampling.sample_per_class(df, "k", "c", n, 1).collect())) == want


def test_large_class_samples_order_no_rows(spark):
    df = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    found = sampling.sample_per_class(df, "k", "c", 10_000, 1)
    assert [r["count"] for r in found.groupBy("c").count().collect()] == [10_000] * 3
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1  # rows that share the n-th hash
