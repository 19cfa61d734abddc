"""Radix selection against numpy and against the ordered way."""

import math
import random

import numpy as np
import pytest

from tabprep.operators import prefix, quantiles

PROBS = [0, 0.05, 0.25, 0.35, 0.5, 0.95, 1]


def test_keys_order_as_doubles_do():
    x = np.array([-math.inf, -1e300, -1.5, -5e-324, 0.0, 5e-324, 1.0, 1e300, math.inf, math.nan])
    keys = quantiles._keys(x)
    assert (np.diff(keys.astype(object)) > 0).all() and quantiles._keys(np.array([-0.0]))[0] == keys[4]
    assert all(a == b or math.isnan(a) and math.isnan(b) for a, b in zip(map(quantiles._value, keys.tolist()), x.tolist(), strict=True))


@pytest.mark.parametrize("held", [1 << 20, 5])
def test_against_numpy(spark, held, monkeypatch):
    monkeypatch.setattr(quantiles, "HELD", held)
    rng = np.random.default_rng(3)
    a, b = rng.integers(-9, 9, 997).astype(float), rng.normal(size=997) * 10.0 ** rng.integers(-300, 300, 997)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)] + [(None, None, None)], "a DOUBLE, b DOUBLE, c DOUBLE")
    got = {r["column"]: r for r in quantiles.exact_quantiles(df.repartition(3), ["a", "b", "c"], PROBS, ordered=0).collect()}
    assert set(got) == {"a", "b"}  # a column without values has no row
    for name, values in (("a", a), ("b", b)):
        assert got[name]["n"] == 997
        assert np.allclose([got[name][f"q{i}"] for i in range(len(PROBS))], np.quantile(values, PROBS), rtol=1e-12)


def test_groups_ties_and_special_numbers_as_by_order(spark):
    r = random.Random(1)
    some = [0.0, -0.0, 1.0, 1.0, 2.5, -2.5, math.inf, -math.inf, math.nan, None]
    rows = [(r.choice(["x", "y", None]), r.randrange(2), r.choice(some), r.choice(some)) for _ in range(300)] + [("lone", 0, 7.0, None)]
    df = spark.createDataFrame(rows, "g STRING, `_0` INT, v DOUBLE, `column` DOUBLE").withColumnRenamed("column", "w")
    for by in ([], ["g"], ["g", "_0"]):
        found = quantiles.exact_quantiles(df, ["v", "w"], [0.1, 0.5, 1], by=by, ordered=0)
        ordered = prefix.exact_quantiles(df, ["v", "w"], [0.1, 0.5, 1], by=by)
        assert found.columns == ordered.columns and found.dtypes == ordered.dtypes
        assert sorted(map(repr, found.collect())) == sorted(map(repr, ordered.collect()))
    many = quantiles.exact_quantiles(df, ["v"], [0.5], by=["g"], most_groups=2)
    assert sorted(map(repr, many.collect())) == sorted(map(repr, quantiles.exact_quantiles(df, ["v"], [0.5], by=["g"], ordered=0).collect()))


def test_nothing_and_integers(spark):
    none = spark.createDataFrame([], "v DOUBLE")
    assert quantiles.exact_quantiles(none, ["v"], [0.5], ordered=-1).count() == 0
    df = spark.range(1, 1001)
    for ordered in (0, quantiles.ORDERED):
        assert tuple(quantiles.exact_quantiles(df, ["id"], [0, 0.5, 1], ordered=ordered).first()) == ("id", 1000, 1.0, 500.5, 1000.0)
