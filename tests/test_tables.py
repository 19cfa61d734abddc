"""Cleaning, joins, profiles, evaluation, ranking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions import vectors as V
from tabprep.operators import clean, evaluate, joins, profile, ranking
from tabprep.operators import vectors as vector_ops


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_impute_keeps_fit_table_apart(spark):
    train = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "k INT, x DOUBLE")
    test = spark.createDataFrame([(1, None), (2, 100.0)], "k INT, x DOUBLE")
    assert rows(clean.impute_median(train, "x")) == [(1, 10.0), (2, 20.0), (3, 15.0)]
    assert rows(clean.impute_median(test, "x", fit=train)) == [(1, 15.0), (2, 100.0)]
    assert rows(clean.impute_median(test, "x")) == [(1, 100.0), (2, 100.0)]


def test_impute_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "k INT, x STRING")
    assert rows(clean.impute_mode(df, "x")) == [(1, "b"), (2, "a"), (3, "a")]


def test_filter_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("a",), (".DS_Store",), (None,)], "image STRING")
    assert {r.image for r in clean.filter_not_equal(df, "image", ".DS_Store").collect()} == {"a", None}


def test_map_categories_unknown_is_null(spark):
    df = spark.createDataFrame([("male",), ("female",), ("x",), (None,)], "s STRING")
    got = [r[0] for r in df.select(clean.map_categories(F.col("s"), {"male": 0, "female": 1})).collect()]
    assert got == [0, 1, None, None]


def test_label_index_by_first_appearance(spark):
    df = spark.createDataFrame([(3, "z"), (1, "y"), (2, "z"), (4, "a")], "k INT, c STRING")
    indexed, names = clean.label_index(df, "c", "k")
    assert rows(names, "c", "label_index") == [("a", 2), ("y", 0), ("z", 1)]
    assert clean.label_map_check(indexed, "label_index", "c").first() == (3, True)
    broken = spark.createDataFrame([(0, "a"), (0, "b")], "label_index INT, c STRING")
    assert clean.label_map_check(broken, "label_index", "c").first().one_to_one is False


@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_lookup_join_broadcast_and_salted_agree(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    # one key holds two thirds of the rows
    df = spark.range(900).select(F.col("id").alias("k"), F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 7).alias("c"))
    nothing = F.when(F.col("id") < 90, F.lit(None).cast("bigint"))
    df = df.unionByName(spark.range(90).select((F.col("id") + 900).alias("k"), nothing.alias("c")))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(6)], "c BIGINT, name STRING")
    small = joins.lookup_join(df, dim, "c", salt_by=F.col("k"))
    salted = joins.lookup_join(df, dim, "c", salt_by=F.col("k"), broadcast_rows=2)
    columns = ["k", F.coalesce("c", F.lit(-1)), F.coalesce("name", F.lit("-"))]
    assert rows(small, *columns) == rows(salted, *columns)
    assert salted.count() == 990


@pytest.mark.parametrize("words", [1, 1 << 19])
def test_a_bitmap_of_any_size_changes_no_result(spark, monkeypatch, words):
    """With one word nearly every row passes the bitmap; the joins drop what does not match."""
    monkeypatch.setattr(joins, "MOST_WORDS", words)
    df = spark.range(500).select(F.col("id").alias("k"), F.when(F.col("id") % 50 != 7, F.col("id") % 300).alias("c"), (F.col("id") % 3).alias("d"))
    dim = spark.range(0, 300, 2).select(F.col("id").alias("c"), (F.col("id") % 3).alias("d"), F.concat(F.lit("n"), "id").alias("name"))
    columns = ["k", F.coalesce("c", F.lit(-1)), "d", F.coalesce("name", F.lit("-"))]
    for how in ("left", "inner"):
        want = rows(df.join(dim, ["c", "d"], how), *columns)
        assert rows(joins.lookup_join(df, dim, ["c", "d"], how, broadcast_rows=1), *columns) == want
    other = spark.range(0, 300, 3).select(F.col("id").alias("c"))
    want = [r.k for r in df.collect() if r.c is None or r.c % 3]
    assert sorted(r.k for r in joins.not_in(df, other, "c", "k").collect()) == want
    monkeypatch.setattr(joins, "fits", lambda *_: False)
    assert sorted(r.k for r in joins.not_in(df, other, "c", "k").collect()) == want


@pytest.mark.parametrize("small", [True, False])
def test_no_text_moves_to_find_new_rows(spark, monkeypatch, small):
    answers = iter([small, True])  # the digests, and those that the bitmap let through wrongly
    monkeypatch.setattr(joins, "fits", lambda *_: next(answers))
    texts = spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("a long text "), "id").alias("t"))
    plan = joins.not_in(texts, texts.filter("k % 2 = 0"), "t", "k")
    assert plan.count() == 200
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in shown and "SortMergeJoin" not in shown


def test_not_in_keeps_null(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "t STRING")
    b = spark.createDataFrame([("x",), (None,)], "t STRING")
    assert {r.t for r in joins.not_in(a, b, "t").collect()} == {"y", None}


def test_not_in_with_a_hot_value_and_no_broadcast(spark, monkeypatch):
    a = spark.range(300).select(F.col("id").alias("k"), F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("t"))
    b = spark.createDataFrame([("hot",), ("250",), ("250",)], "t STRING")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    assert sorted(r.k for r in joins.not_in(a, b, "t", "k").collect()) == [k for k in range(200, 300) if k != 250]


def test_label_index_keeps_rows_without_label(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k INT, c STRING")
    indexed, _ = clean.label_index(df, "c", "k")
    assert sorted((r.k, r.label_index) for r in indexed.collect()) == [(1, 0), (2, None)]


def test_stored_prediction_numbers(spark):
    """75 samples, 25 per class, three errors: 2 -> 3 once, 3 -> 2 twice."""
    pairs = [(1, 1)] * 25 + [(2, 2)] * 24 + [(2, 3)] + [(3, 3)] * 23 + [(3, 2)] * 2
    df = spark.createDataFrame(pairs, "label INT, prediction INT")
    assert evaluate.accuracy(df).first()[0] == 0.96
    grid = {(r.actual, r.predicted): r.n for r in evaluate.confusion_matrix(df).collect()}
    assert len(grid) == 9 and grid[2, 3] == 1 and grid[3, 2] == 2 and grid[1, 2] == 0
    report = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert report["2"].precision == pytest.approx(24 / 26)
    assert report["3"].recall == pytest.approx(23 / 25)
    assert report["accuracy"].f1 == pytest.approx(0.96)
    assert report["macro avg"].support == 75


def test_report_counts_zero_over_zero_as_zero(spark):
    df = spark.createDataFrame([(0, 1), (0, 0)], "label INT, prediction INT")
    r = {x.label: x for x in evaluate.classification_report(df).collect()}
    assert (r["1"].recall, r["1"].precision, r["1"].f1, r["1"].support) == (0.0, 0.0, 0.0, 0)


@pytest.mark.parametrize("votes,want", [((1, 2, 2), 2), ((1, 1, 2), 1), ((3, 1, 2), 3), ((2, 1, 2), 2)])
def test_majority_vote(spark, votes, want):
    df = spark.createDataFrame([votes], "a INT, b INT, c INT")
    assert df.select(evaluate.majority_vote(["a", "b", "c"])).first()[0] == want


def test_cross_entropy_batch_mean_differs_from_row_mean(spark):
    logits = [(0, [0.0, 0.0], 0), (1, [0.0, 0.0], 1), (2, [2.0, 0.0], 1)]
    df = spark.createDataFrame(logits, "k INT, z ARRAY<DOUBLE>, y INT")
    got = evaluate.cross_entropy(df, "k", "z", "y", batch=2).first()
    import math

    a, b = math.log(2), math.log(1 + math.exp(2))
    assert got.batch_loss == pytest.approx((a + b) / 2)
    assert got.row_loss == pytest.approx((2 * a + b) / 3)


def test_histogram_last_bin_closed_and_constant(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10)], "x DOUBLE")
    assert [r.n for r in profile.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 1]
    flat = spark.createDataFrame([(4.0,)] * 3, "x DOUBLE")
    h = profile.histogram(flat, "x", 4).orderBy("bin").collect()
    assert [r.n for r in h] == [0, 0, 3, 0] and (h[0].lo, h[3].hi) == (3.5, 4.5)


def test_box_whiskers_stop_at_points(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "x DOUBLE")
    b = profile.box_summary(df, ["x"]).first()
    assert (b.q1, b.median, b.q3, b.whisker_low, b.whisker_high, b.outliers) == (2, 3, 4, 1, 4, 1)


@pytest.mark.parametrize("values", [[0.0, 1.0, 1.5, 9.0, 9.0, -3.0], [float(i % 17) ** 2 for i in range(300)], [1e6, 1e6 + 1, -1e9], [5.0, 5.0], [2.0], []])
def test_density_equals_the_sum_of_all_kernels(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x DOUBLE").repartition(3)
    found = {r.point: r for r in profile.density(df, "x", 50, reach=2).collect()}
    if not values:
        assert not found
        return
    h = len(values) ** -0.2 * np.std(values, ddof=1) if len(set(values)) > 1 else 0
    grid = np.linspace(min(values) - 2 * h, max(values) + 2 * h, 50)
    assert np.allclose([found[i].x for i in range(50)], grid, rtol=1e-12)
    if not h:
        assert all(r.density is None for r in found.values())
        return
    want = np.exp(-(((grid[:, None] - np.array(values)) / h) ** 2) / 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.abs(np.array([found[i].density for i in range(50)]) - want).max() < 1e-9 / h


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(x % 17),) for x in range(300)], "x DOUBLE")
    d = profile.density(df, "x", 400, reach=4).orderBy("x").collect()
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(d, d[1:]))
    assert area == pytest.approx(1, abs=1e-3)


def test_language_counts_flags_failures(spark):
    df = spark.createDataFrame([("en",), ("en",), ("unknown",)], "l STRING")
    assert [tuple(r) for r in profile.language_counts(df, "l").collect()] == [("en", 2, False), ("unknown", 1, True)]


def stop(spark, metrics, **options):
    log = spark.createDataFrame([("r", i, m) for i, m in enumerate(metrics)], "run STRING, epoch INT, m DOUBLE")
    return tuple(ranking.early_stop(log, "run", "epoch", "m", **options).first())[1:]


def test_early_stop_is_not_a_running_minimum(spark):
    # each step improves by less than delta, so the best never moves
    assert stop(spark, [1.0, 0.9995, 0.999, 0.9985], patience=3, delta=0.01) == (1.0, 0, 3)
    assert stop(spark, [1.0, 0.5, 0.6, 0.4], patience=3, delta=0.0) == (0.4, 3, None)
    assert stop(spark, [0.1, 0.3, 0.2, 0.25], patience=2, delta=0.0, mode="max") == (0.3, 1, 3)


def test_early_stop_without_reset(spark):
    metrics = [1.0, 2.0, 0.5, 2.0, 0.4, 2.0]
    assert stop(spark, metrics, patience=3, delta=0.0) == (0.4, 4, None)
    assert stop(spark, metrics, patience=3, delta=0.0, reset_counter=False) == (0.4, 4, 5)


def test_batches(spark):
    df = spark.range(10).toDF("k")
    kept = ranking.with_batch(df, "k", size=4)
    assert [r.batch_id for r in kept.orderBy("k").collect()] == [0] * 4 + [1] * 4 + [2] * 2
    assert ranking.with_batch(df, "k", size=4, drop_last=True).count() == 8


def test_argmax_and_rank_ties_take_the_first(spark):
    df = spark.createDataFrame([(1, [0.2, 0.4, 0.4])], "k INT, p ARRAY<DOUBLE>")
    assert df.select(V.argmax(F.col("p"))).first()[0] == 1
    assert [(r.rank, r["class"]) for r in ranking.rank_scores(df, "p").orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 0)]
    top = ranking.top2(df, "p").first()
    assert (top["first"], top["second"], top["margin"]) == (0.4, 0.4, 0.0)


def test_minmax_constant_column_and_no_clipping(spark):
    train = spark.createDataFrame([(0.0, 5.0), (2.0, 5.0)], "a DOUBLE, b DOUBLE")
    test = spark.createDataFrame([(4.0, 5.0)], "a DOUBLE, b DOUBLE")
    assert rows(vector_ops.minmax_scale(train, ["a", "b"])) == [(0.0, 0.0), (1.0, 0.0)]
    assert rows(vector_ops.minmax_scale(test, ["a", "b"], fit=train)) == [(2.0, 0.0)]


def test_softmax_is_stable_and_sums_to_one(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "z ARRAY<DOUBLE>")
    p = df.select(V.softmax(F.col("z"))).first()[0]
    assert p == [0.5, 0.5, 0.0]
    assert df.select(V.l2_normalize(F.array(F.lit(0.0), F.lit(0.0)))).first()[0] == [0.0, 0.0]


def test_arc_margin_smoothing(spark):
    import math

    c, s, m, eps = [0.3, -0.95], 30.0, 0.5, 0.1
    df = spark.createDataFrame([(c, 1)], "c ARRAY<DOUBLE>, y INT")
    got = df.select(V.arc_margin(F.col("c"), F.col("y"), s, m, eps=eps, k=2)).first()[0]
    for i, x in enumerate(c):
        phi = math.cos(math.acos(x) + m) if x > math.cos(math.pi - m) else x - math.sin(math.pi - m) * m
        w = (1 - eps) * (i == 1) + eps / 2
        assert got[i] == pytest.approx(s * (w * phi + (1 - w) * x))


def test_missing_predictions_are_no_hits(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, None, 1), (0, None, 1)], "label INT, prediction INT, run INT")
    assert evaluate.accuracy(df).first()[0] == pytest.approx(1 / 3)
    assert evaluate.repeat_run_stats(df, "run").first()[0] == pytest.approx(1 / 3)
    pair = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a INT, b INT")
    assert tuple(evaluate.agreement_counts(pair, ["a", "b"]).first()) == (2, 2)


def test_salts_follow_the_number_of_rows_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("c"))
    dim = spark.createDataFrame([(0, "hot"), (950, "x"), (5000, "y")], "c BIGINT, name STRING")
    want = rows(joins.lookup_join(df, dim, "c"), "k", F.coalesce("name", F.lit("-")))
    assert rows(joins.lookup_join(df, dim, "c", broadcast_rows=1), "k", F.coalesce("name", F.lit("-"))) == want
    assert joins.fits(dim, 3) and not joins.fits(dim, 2) and not joins.fits(dim, 3, 10)
