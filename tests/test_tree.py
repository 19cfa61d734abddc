"""The exact tree against a small recursive one, and its reports."""

import random
from math import log2

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tabprep.functions.numbers import round2_exact  # noqa: F401
from tabprep.operators import evaluate, splits
from tabprep.plans import tree
from tabprep.session import shared_dir

NAMES = ["a", "b", "c"]


def brute(rows, depth, most):
    """Nested (feature, threshold, left, right) or a label."""
    labels = [r[-1] for r in rows]
    majority = min(set(labels), key=lambda x: (-labels.count(x), x))
    if len(set(labels)) == 1 or depth == most:
        return majority

    def h(ys):
        return -sum(p * log2(p) for p in (ys.count(y) / len(ys) for y in set(ys)))

    best = None
    for f in range(len(NAMES)):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:]):
            t = (lo + hi) / 2
            left = [r[-1] for r in rows if r[f] <= t]
            right = [r[-1] for r in rows if r[f] > t]
            gain = round(h(labels) - (len(left) * h(left) + len(right) * h(right)) / len(rows), 12)
            if best is None or gain > best[0]:
                best = (gain, f, t)
    if best is None:
        return majority
    _, f, t = best
    return f, t, brute([r for r in rows if r[f] <= t], depth + 1, most), brute([r for r in rows if r[f] > t], depth + 1, most)


def nested(nodes, i=1):
    n = nodes[i]
    return n.label if n.feature is None else (n.feature_no, n.threshold, nested(nodes, n.left_id), nested(nodes, n.right_id))


def fit(spark, rows, depth, task_cells=tree.TASK_CELLS):
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, label INT")
    nodes = tree.id3_fit(df, NAMES, "label", depth, task_cells)
    return df, nodes, {r.node_id: r for r in nodes.collect()}


@pytest.mark.parametrize("seed,depth,task_cells", [(1, 3, 0), (2, 30, 1 << 20), (2, 4, 45), (3, 10, 20)])
def test_same_tree_as_brute_force(spark, seed, depth, task_cells):
    """All levels distributed, none, and large nodes only."""
    rng = random.Random(seed)
    rows = [(rng.randrange(6) / 2, rng.randrange(4) * 1.0, rng.randrange(3) * 1.0, rng.randrange(3)) for _ in range(40)]
    _, _, nodes = fit(spark, rows, depth, task_cells)
    assert nested(nodes) == brute(rows, 0, depth)


def test_ten_levels_over_many_columns():
    """The presorted lists against brute force, whatever slices of boundaries are counted at once."""
    from tabprep.plans import subtree

    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3, 300)), 2)
    y = rng.integers(0, 4, 300)
    rows = [(*v, c) for v, c in zip(x.T.tolist(), y.tolist(), strict=True)]
    for counts in (1 << 21, 7):
        subtree._COUNTS, kept = counts, subtree._COUNTS
        found = {n[0]: Row(node_id=n[0], feature=n[2], feature_no=n[2], threshold=n[3], label=n[4], left_id=2 * n[0], right_id=2 * n[0] + 1) for n in subtree.grow(x, y, 1, 0, 10)}
        subtree._COUNTS = kept
        assert nested(found) == brute(rows, 0, 10)


def test_a_large_tree_is_joined_level_by_level(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, float("nan"), rng.random()]), rng.random(), rng.randrange(3) * 1.0, rng.randrange(3)) for _ in range(80)]
    df, nodes, _ = fit(spark, rows, 6)
    keyed = df.withColumn("k", F.monotonically_increasing_id())
    literal = tree.id3_predict(keyed, nodes, NAMES, False).select("k", "prediction").collect()
    assert sorted(literal) == sorted(tree.id3_predict(keyed, nodes, NAMES, False, literal_nodes=3).select("k", "prediction").collect())


def test_zero_gain_split_is_taken(spark):
    rows = [(0.0, 0.0, 1.0, 0), (0.0, 1.0, 1.0, 1), (1.0, 0.0, 1.0, 1), (1.0, 1.0, 1.0, 0)]
    df, nodes, by_id = fit(spark, rows, 5)
    assert nested(by_id) == (0, 0.5, (1, 0.5, 0, 1), (1, 0.5, 1, 0))
    assert evaluate.accuracy(tree.id3_predict(df, nodes, NAMES)).first()[0] == 1.0


def test_single_class_and_no_split(spark):
    _, _, pure = fit(spark, [(1.0, 2.0, 3.0, 7), (2.0, 2.0, 3.0, 7)], 5)
    assert nested(pure) == 7
    _, _, same = fit(spark, [(1.0, 2.0, 3.0, 4), (1.0, 2.0, 3.0, 2)], 5)
    assert nested(same) == 2


def test_rounded_thresholds_change_predictions_only_by_option(spark):
    rows = [(1.000, 0.0, 0.0, 0), (1.004, 0.0, 0.0, 1)]
    df, nodes, _ = fit(spark, rows, 3)
    exact = tree.id3_predict(df, nodes, NAMES, threshold_2dp=False)
    assert evaluate.accuracy(exact).first()[0] == 1.0
    # 1.002 reads as 1.00 in the printed tree
    assert sorted(r.prediction for r in tree.id3_predict(df, nodes, NAMES).collect()) == [0, 1]
    rows = [(1.004, 0.0, 0.0, 0), (1.009, 0.0, 0.0, 1)]
    df, nodes, _ = fit(spark, rows, 3)
    assert [r.prediction for r in tree.id3_predict(df, nodes, NAMES).collect()] == [0, 0]


def test_large_group_way_gives_the_same_candidates(spark):
    rng = random.Random(4)
    rows = [(rng.random(), rng.randrange(50) * 1.0, 0.0, rng.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, label INT")
    small = splits.split_scan(df, NAMES, "label", [0, 1, 2])
    large = splits.split_scan(df, NAMES, "label", [0, 1, 2], bucket_rows=7)
    assert sorted(small.collect()) == sorted(large.collect())


def test_text_reports(spark, tmp_path):
    from tabprep.sources import writers

    rows = [(0.0, 0.0, 1.0, 0), (0.0, 1.0, 1.0, 1), (1.0, 0.0, 1.0, 1), (1.0, 1.0, 1.0, 0)]
    _, nodes, _ = fit(spark, rows, 5)
    writers.write_tree(nodes, str(tmp_path / "t"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).splitlines()
    assert lines == ["a ≤ 0.50:", "  b ≤ 0.50:", "    Label: 0", "    Label: 1", "  b ≤ 0.50:", "    Label: 1", "    Label: 0"]


@pytest.mark.parametrize("task_cells", [0, tree.TASK_CELLS])
def test_missing_features_and_labels(spark, task_cells):
    rows = [(1.0, 0), (2.0, 0), (None, 1), (float("nan"), 1), (9.0, 1), (3.0, None)]
    df = spark.createDataFrame(rows, "x DOUBLE, y INT")
    scan = splits.split_scan(df, ["x"], "y", splits.class_list(df, "y")).collect()
    assert [(r.threshold, r.n, r.n_left) for r in sorted(scan, key=lambda r: r.threshold)] == [(1.5, 3, 1), (5.5, 3, 2)]
    nodes = tree.id3_fit(df, ["x"], "y", task_cells=task_cells)
    found = sorted((r.node_id, r.threshold, r.label, r.n) for r in nodes.select("node_id", F.coalesce("threshold", F.lit(-1.0)).alias("threshold"), "label", "n").collect())
    assert found == [(1, 5.5, 1, 5), (2, -1.0, 0, 2), (3, -1.0, 1, 3)]  # missing values go right
    got = [r.prediction for r in tree.id3_predict(df.withColumn("k", F.monotonically_increasing_id()), nodes, ["x"]).orderBy("k").collect()]
    assert got == [0, 0, 1, 1, 1, 0]


def test_a_table_without_labels_is_refused(spark):
    with pytest.raises(ValueError):
        tree.id3_fit(spark.createDataFrame([(1.0, None)], "x DOUBLE, y INT"), ["x"], "y")


def test_table_job_fills_each_table_by_itself_and_tells_held_out_rows(spark):
    from tabprep.plans import tables

    rng = random.Random(8)
    rows = [(i, rng.choice([None, rng.randrange(100) * 1.0]), rng.choice(["m", "f"]), "junk") for i in range(300)]
    train = [(*r, 1 if (r[1] or 0) > 50 and r[2] == "f" else 0) for r in rows]
    df = spark.createDataFrame(train, "k INT, age DOUBLE, sex STRING, cabin STRING, alive INT")
    test = spark.createDataFrame([(900, 70.0, "f", "x"), (901, None, None, "x"), (902, 70.0, "m", "x"), (903, 20.0, "x", "x")], "k INT, age DOUBLE, sex STRING, cabin STRING")
    prepare = tables.Preparation(["age"], ["sex"], {"sex": {"m": 0, "f": 1}}, ["cabin"])
    found = tables.table_job(df, test, "k", "alive", ["age", "sex"], prepare)
    assert found.held_out.count() == 60 and found.accuracy("alive").first()[0] > 0.75
    told = {r.k: r.alive for r in found.submission.collect()}
    assert set(told) == {900, 901, 902, 903} and told[900] == 1 and told[902] == 0
    filled = {r.k: (r.age, r.sex) for r in prepare(test).collect()}
    assert filled[901] == (70.0, 1) and filled[903] == (20.0, None) and "cabin" not in prepare(test).columns


def spread_rows(n, features, classes, seed, places=None):
    """Rows of some features that tell the label, whole numbers if ``places`` is 0."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(n, features)) + 0.8 * rng.normal(size=(classes, features))[y]
    return (x if places is None else np.round(x, places)) + 0.0, y


@pytest.mark.parametrize("places,missing", [(None, 0), (1, 0.2)])
def test_large_nodes_are_split_as_small_ones(spark, monkeypatch, places, missing):
    """Ten classes and few ranges: borders, values inside ranges, repeated rows and missing values give one tree."""
    from tabprep.plans import level

    monkeypatch.setattr(level, "RANGES", 8)
    x, y = spread_rows(700, 3, 10, 5, places)
    gone = np.random.default_rng(6).random(x.shape) < missing
    rows = [(*[None if g else v for v, g in zip(xs, gs)], c) for xs, gs, c in zip(x.tolist(), gone.tolist(), y.tolist(), strict=True)]
    trees = []
    for cells in (0, 1500, tree.TASK_CELLS):
        _, _, nodes = fit(spark, rows * 2, 3, cells)
        trees.append({i: (n.feature, n.threshold, n.label, n.n) for i, n in nodes.items()})
    assert trees[0] == trees[1] == trees[2] and trees[0][1][3] == 1400


def test_a_large_table_is_reduced_to_its_distinct_rows(spark, monkeypatch):
    """Copies of rows do not move: what is grown in a task are distinct rows with their numbers."""
    x, y = spread_rows(60, 3, 3, 7, 1)
    seen = []
    monkeypatch.setattr(tree, "cut", lambda df: seen.append(df) or df.localCheckpoint())
    fit(spark, [(*v, c) for v, c in zip(x.tolist(), y.tolist(), strict=True)] * 30, 3, 300)
    first = seen[0]
    assert first.agg(F.count("*"), F.sum("_w")).first()[1] == 1800 and first.count() <= 60


def test_many_levels_of_large_nodes_are_planned_like_one(spark, monkeypatch):
    """A plan holds one level's steps; those of a chain of levels once took minutes to plan at depth 10."""
    from tabprep.plans import level

    known = []

    def kept(df):
        known.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return df.checkpoint()

    shared_dir(spark)
    for module in (tree, level):
        monkeypatch.setattr(module, "cut", kept)
    x, y = spread_rows(400, 3, 2, 11)
    _, _, nodes = fit(spark, [(*v, c) for v, c in zip(x.tolist(), y.tolist(), strict=True)], 6, 90)
    assert max(n.depth for n in nodes.values()) == 6 and max(known) < 2000


def test_a_threshold_that_is_rounded_up_parts_nothing(spark):
    """Between the second and third of these values there is no number; the mean of the two is the third."""
    a = [1.0, float(np.nextafter(1.0, 2.0)), float(np.nextafter(np.nextafter(1.0, 2.0), 2.0))]
    assert (a[1] + a[2]) / 2 == a[2]
    rows = [(v, 0.0, 0.0, c) for v, c in [(a[1], 0), (a[1], 0), (a[2], 1), (3.0, 1), (3.0, 0)]] * 3
    trees = []
    for cells in (0, tree.TASK_CELLS):
        _, _, nodes = fit(spark, rows, 4, cells)
        trees.append({i: (n.feature, n.threshold, n.label, n.n) for i, n in nodes.items()})
    assert trees[0] == trees[1] and trees[0][1][1] == a[2]


def test_counts_of_many_tasks_and_large_ranges_are_added_in_steps(spark, monkeypatch):
    from tabprep.plans import level

    x, y = spread_rows(500, 3, 4, 12)
    df = spark.createDataFrame([(*v, c) for v, c in zip(x.tolist(), y.tolist(), strict=True)], "a DOUBLE, b DOUBLE, c DOUBLE, label INT").repartition(9)
    want = sorted(tree.id3_fit(df, NAMES, "label", 3).select("node_id", "label", "n").collect())
    for name, value in (("TASKS", 2), ("RANGES", 4), ("SEARCHED", 60), ("COUNTS", 35), ("VALUES", 30), ("HELD", 100), ("CHUNK", 60), ("SENT", 40), ("FEWEST", 2)):
        monkeypatch.setattr(level, name, value)
    monkeypatch.setattr(tree, "SCANS", 1)
    assert sorted(tree.id3_fit(df, NAMES, "label", 3, 0).select("node_id", "label", "n").collect()) == want

