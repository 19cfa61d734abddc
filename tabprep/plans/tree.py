"""An exact information-gain tree: large nodes by distributed split searches, small ones each in a task.

While a node is large, a level is one split search over the rows of all large nodes, most of it over class counts
per range of values (``plans.level``). The rows of a node that fits into a task move there once, and its whole
subtree is grown from presorted attribute lists.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tabprep.functions.numbers import round2_exact
from tabprep.operators.joins import lookup_join
from tabprep.operators.splits import class_list
from tabprep.plans.level import Best, best_splits, dealt, packed, ranges, totals
from tabprep.plans.subtree import grow
from tabprep.session import cut

_SPLIT = ["feature_no", "feature", "threshold"]
#: Values (rows x features, or rows x classes if those are more) of a node that one task grows.
TASK_CELLS = 1 << 22
#: Tasks per core that read large nodes, each of which sends its counts.
SCANS = 4
#: Nodes of a tree that prediction carries as a literal.
LITERAL_NODES = 1 << 14


def id3_fit(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 10, task_cells: int = TASK_CELLS) -> DataFrame:
    """The tree as a node table.

    ``(node_id, depth, feature_no, feature, threshold, threshold_2dp, left_id, right_id, label, n)``;
    node ids are heap ids (children 2i and 2i + 1), leaves have no feature, and ``label`` is
    the majority class of the node (the smallest one on ties). A node stays a leaf when it
    is pure, at ``max_depth``, or no column has two distinct values; a split without gain
    is taken. A missing (NULL or NaN) feature goes right, as in prediction; rows without a
    label are left out. Where the work is done does not change the tree.

    A table too large for one task is first reduced to its distinct rows, each with its number, and those are packed
    into chunks. A level of large nodes reads the chunks twice, for counts per range and for the values of some ranges;
    a row's node follows from the splits so far, so chunks are never written again. Rows of nodes of at most ``task_cells``
    values move once, at the end, to the task that grows the node's subtree. The driver holds the large nodes.
    """
    classes = class_list(df, label)
    if not classes:
        raise ValueError(f"no row has a {label}")
    rows = df.filter(F.col(label).isNotNull()).select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).alias("_y"))
    small = task_cells // max(len(features), len(classes))  # rows of a node that one task grows
    if rows.count() > small:
        rows = rows.groupBy(*features, "_y").agg(F.count(F.lit(1)).alias("_w"))
    else:
        rows = rows.withColumn("_w", F.lit(1).cast("bigint"))
    rows = cut(rows).coalesce(SCANS * df.sparkSession.sparkContext.defaultParallelism)
    chunks = cut(packed(rows, features, classes))
    k, width = len(classes), len(features)
    splits: dict[int, tuple[int, float]] = {}
    large, waiting, ends = [], [], None
    level = totals(chunks, width, k, splits, [1])
    for depth in range(max_depth + 1):
        waiting += [node for node, n in level.items() if n[k] <= small]
        level = {node: n for node, n in level.items() if n[k] > small}
        mixed = [node for node, n in level.items() if np.count_nonzero(n[:k]) > 1] if depth < max_depth and features else []
        best: dict[int, Best] = {}
        if mixed:
            ends = ends or ranges(chunks, width, k, int(level[mixed[0]][k]))
            best = best_splits(chunks, width, k, ends, splits, mixed)
        for node, n in level.items():
            feature, threshold, _ = best.get(node, (None, None, None))
            large.append((node, depth, feature, threshold, classes[int(n[:k].argmax())], int(n[:k].sum())))
        if not best:
            break
        splits |= {node: (b.feature, b.threshold) for node, b in best.items()}
        below = {}
        for node, b in best.items():
            if b.left is not None:
                below |= {2 * node: b.left, 2 * node + 1: level[node] - b.left}
        if unknown := [child for node, b in best.items() if b.left is None for child in (2 * node, 2 * node + 1)]:
            below |= totals(chunks, width, k, splits, unknown)
        level = below
    names = F.array(*[F.lit(f) for f in features])
    schema = f"node_id bigint, depth int, feature_no int, threshold double, label {df.schema[label].dataType.simpleString()}, n bigint"
    nodes = df.sparkSession.createDataFrame(large, schema)
    if waiting:  # all at once, so that one node's task does not hold up a level
        nodes = nodes.unionByName(dealt(chunks, width, splits, waiting, _grower(classes, max_depth, schema), schema))
    nodes = cut(nodes.withColumn("feature", F.get(names, "feature_no")))
    inner = F.col("feature").isNotNull()
    return nodes.select(
        "node_id",
        "depth",
        *_SPLIT,
        round2_exact(F.col("threshold")).alias("threshold_2dp"),
        F.when(inner, F.col("node_id") * 2).alias("left_id"),
        F.when(inner, F.col("node_id") * 2 + 1).alias("right_id"),
        "label",
        "n",
    )


def _grower(classes: Sequence[int], max_depth: int, schema: str) -> Callable[[int, np.ndarray, np.ndarray, np.ndarray], pa.Table]:
    """The function from the rows of a node to the nodes of its subtree. A heap id tells the depth."""
    labels, kinds = np.array(classes), to_arrow_schema(StructType.fromDDL(schema))

    def run(node: int, x: np.ndarray, y: np.ndarray, times: np.ndarray) -> pa.Table:
        nodes = grow(x, labels[y], node, node.bit_length() - 1, max_depth, times if (times > 1).any() else None)
        return pa.table([pa.array(v, f.type) for v, f in zip(zip(*nodes, strict=True), kinds, strict=True)], schema=kinds)

    return run


def _descend(
    rows: DataFrame, split: DataFrame, features: Sequence[str], how: str, splits: int
) -> DataFrame:
    """Move rows to the child their value points to; rows of leaves drop out of an inner join.

    Near the root one node holds most rows, so the join broadcasts the splits or salts the rows.
    """
    columns = [c for c in rows.columns if c != "node_id"]
    joined = lookup_join(rows, split, "node_id", how, F.struct(*features), dim_rows=splits)
    value = F.get(F.array(*features), F.col("feature_no"))
    # NaN is above any number; NULL goes the same way
    right = F.coalesce(value > F.col("threshold"), F.lit(True))
    child = F.col("node_id") * 2 + right.cast("int")
    return joined.select(*columns, F.when(F.col("feature_no").isNull(), F.col("node_id")).otherwise(child).alias("node_id"))


def id3_predict(
    df: DataFrame, nodes: DataFrame, features: Sequence[str], threshold_2dp: bool = True, literal_nodes: int = LITERAL_NODES
) -> DataFrame:
    """Add ``prediction``, the label of the leaf a row falls into.

    Thresholds are rounded to two decimals here by default, as they are printed in the tree.
    A tree of at most ``literal_nodes`` nodes is part of the plan, and a row walks down in one
    projection; a larger one is joined level by level.
    """
    nodes = cut(nodes)
    bound = F.col("threshold_2dp" if threshold_2dp else "threshold")
    table = nodes.select("node_id", "depth", "feature_no", bound.alias("threshold"), "label")
    found = table.limit(literal_nodes + 1).collect()
    if len(found) <= literal_nodes:
        return df.withColumn("prediction", _walk(found, features, nodes.schema["label"].dataType.simpleString()))
    inner = table.filter(F.col("feature_no").isNotNull()).drop("label")
    per_depth = inner.groupBy("depth").count().orderBy("depth").collect()  # one row per level
    rows = df.withColumn("node_id", F.lit(1).cast("bigint"))
    for d, n in per_depth:
        rows = _descend(rows, inner.filter(F.col("depth") == d).drop("depth"), features, "left", n)
    leaves = nodes.select("node_id", F.col("label").alias("prediction"))
    return lookup_join(rows, leaves, "node_id", "left", F.struct(*features)).drop("node_id")


def _walk(nodes: list, features: Sequence[str], kind: str) -> Column:
    """The label of a row's leaf: as many steps as the tree is deep, over arrays by place of a node."""
    place = {r.node_id: i for i, r in enumerate(sorted(nodes, key=lambda r: r.node_id))}
    rows = sorted(nodes, key=lambda r: r.node_id)

    def literal(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")

    inner = [r.feature_no is not None for r in rows]
    feature = literal([r.feature_no if i else None for r, i in zip(rows, inner, strict=True)], "int")
    threshold = literal([r.threshold if i else None for r, i in zip(rows, inner, strict=True)], "double")
    left = literal([place[2 * r.node_id] if i else None for r, i in zip(rows, inner, strict=True)], "int")
    right = literal([place[2 * r.node_id + 1] if i else None for r, i in zip(rows, inner, strict=True)], "int")
    label = literal([r.label for r in rows], kind)
    values = F.array(*[F.col(f).cast("double") for f in features]) if features else F.array().cast("array<double>")

    def step(at: Column, row: Column) -> Column:
        value, limit = F.get(row["v"], F.get(feature, at)), F.get(threshold, at)
        # NaN is above any number; NULL goes the same way
        down = F.when(F.coalesce(value > limit, F.lit(True)), F.get(right, at)).otherwise(F.get(left, at))
        return F.when(F.get(feature, at).isNull(), at).otherwise(down)

    deepest = max((r.depth for r in rows), default=0)
    # the row's values stand in every step's element, so each is read once
    steps = F.array_repeat(F.struct(values.alias("v")), deepest)
    return F.get(label, F.aggregate(steps, F.lit(place.get(1, 0)), step))


def tree_lines(nodes: DataFrame) -> DataFrame:
    """``(path, line)``: the tree as indented text; ordering by ``path`` gives the pre-order.

    The path is the node id in binary without its leading one.
    """
    rule = F.format_string("%s ≤ %.2f:", "feature", "threshold_2dp")
    leaf = F.concat(F.lit("Label: "), F.col("label").cast("string"))
    text = F.when(F.col("feature").isNull(), leaf).otherwise(rule)
    return nodes.select(
        F.substring(F.bin("node_id"), 2, 64).alias("path"),
        F.concat(F.repeat(F.lit("  "), F.col("depth")), text).alias("line"),
    )


def prediction_line(ordinal: str, label: str, prediction: str) -> Column:
    """``Sample i: True Label = t, Predicted = p``."""
    return F.format_string(
        "Sample %d: True Label = %d, Predicted = %d",
        F.col(ordinal),
        F.col(label),
        F.col(prediction),
    )
