"""Column functions on ``ARRAY<DOUBLE>``: scores, probabilities, scaling.

Built from higher-order functions, so they stay in the JVM. A lambda evaluates a captured
expression once per element; ``let`` and ``array_repeat`` keep that to once per row.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12
MOST_WEIGHTS = 4_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    """Euclidean length, floored so that a zero vector can be divided by it."""
    return F.greatest(F.sqrt(dot(a, a)), F.lit(NORM_FLOOR))


def divide(a: Column, by: Column) -> Column:
    return F.zip_with(a, F.array_repeat(by, F.size(a)), lambda x, d: x / d)


def l2_normalize(a: Column) -> Column:
    return divide(a, norm(a))


def sigmoid(a: Column) -> Column:
    return F.transform(a, lambda x: 1 / (1 + F.exp(-x)))


def relu(a: Column) -> Column:
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))


def softmax(a: Column) -> Column:
    shifted = F.zip_with(a, F.array_repeat(F.array_max(a), F.size(a)), lambda x, m: F.exp(x - m))
    return let(shifted, lambda e: divide(e, total(e)))


def log_sum_exp(a: Column) -> Column:
    return let(F.array_max(a), lambda m: m + F.log(total(F.transform(a, lambda x: F.exp(x - m)))))


def cross_entropy(logits: Column, label: Column) -> Column:
    """-ln softmax(logits)[label] per row."""
    return log_sum_exp(logits) - F.get(logits, label)


def argmax(a: Column) -> Column:
    """Index of the largest value, the first one on ties."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def ranked(a: Column) -> Column:
    """``ARRAY<STRUCT<score, index>>`` from the highest score down; ties by index."""
    keyed = F.transform(a, lambda x, i: F.struct((-x).alias("neg"), i.alias("index")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct((-s["neg"]).alias("score"), s["index"].alias("index"))
    )


def one_hot(label: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == label).cast("double"))


def label_smooth(onehot: Column, eps: float, k: int) -> Column:
    return F.transform(onehot, lambda x: (1 - eps) * x + eps / k)


def minmax_scale(x: Column, lo: Column, hi: Column) -> Column:
    """(x - lo) / (hi - lo), not clipped; a constant column gives x - lo."""
    span = hi - lo
    return (x - lo) / F.when(span == 0, F.lit(1.0)).otherwise(span)


def standardize(a: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """(x - mean) / std per channel; channels are interleaved."""
    c, m, s = len(mean), _doubles(mean), _doubles(std)
    return F.transform(a, lambda x, i: (x - F.get(m, i % c)) / F.get(s, i % c))


def unstandardize(a: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """Inverse of :func:`standardize`, clipped to [0, 1]."""
    c, m, s = len(mean), _doubles(mean), _doubles(std)
    return F.transform(
        a, lambda x, i: F.least(F.greatest(x * F.get(s, i % c) + F.get(m, i % c), F.lit(0.0)), F.lit(1.0))
    )


def rescale(a: Column, scale: float, shift: float) -> Column:
    return F.transform(a, lambda x: x * scale + shift)


def _doubles(xs: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in xs])


def matrix(rows: Sequence[Sequence[float]]) -> Column:
    return F.array(*[_doubles(r) for r in rows])


def affine(a: Column, weight_rows: Column, bias: Column) -> Column:
    """Row vector times matrix plus bias; ``weight_rows`` has one array per output."""
    products = let(a, lambda v: F.transform(weight_rows, lambda w: dot(w, v)))
    return F.zip_with(products, bias, lambda x, b: x + b)


def class_matrix(weights: DataFrame, cls: str = "class", pos: str = "pos", w: str = "w") -> Column:
    """Unit class vectors as one ``ARRAY<ARRAY<DOUBLE>>`` literal, in class order.

    ``weights`` is long ``(class, pos, w)``: the scoring head of a model, whose size is
    classes x dimensions and does not grow with the rows it scores. It passes the driver,
    so more than ``MOST_WEIGHTS`` are refused. As a literal it is part of the plan and of no row.
    """
    if weights.limit(MOST_WEIGHTS + 1).count() > MOST_WEIGHTS:
        raise ValueError(f"a scoring head of more than {MOST_WEIGHTS} weights")
    rows = weights.groupBy(cls).agg(F.array_sort(F.collect_list(F.struct(pos, w))).alias("r"))
    found = rows.select(cls, l2_normalize(F.transform("r", lambda s: s[w])).alias("r")).orderBy(cls).collect()
    return F.from_json(F.lit(json.dumps([r["r"] for r in found])), "array<array<double>>")


def cosine_scores(a: Column, unit_rows: Column) -> Column:
    """Cosine of a vector to each unit class vector."""
    return let(a, lambda v: divide(F.transform(unit_rows, lambda w: dot(w, v)), norm(v)))


def arc_margin(
    cosines: Column, label: Column, s: float, m: float, easy: bool = False, eps: float = 0.0, k: int = 1
) -> Column:
    """Additive angular margin: the target class moves from cos t to cos(t + m), all scaled by s.

    ``eps`` smooths the target over ``k`` classes: each class is a mix of moved and plain cosine.
    """
    cos_m, sin_m = math.cos(m), math.sin(m)
    limit, fallback = math.cos(math.pi - m), math.sin(math.pi - m) * m

    def moved(c: Column) -> Column:
        phi = c * cos_m - F.sqrt(F.greatest(1 - c * c, F.lit(0.0))) * sin_m
        return F.when(c > 0, phi).otherwise(c) if easy else F.when(c > limit, phi).otherwise(c - fallback)

    def mixed(c: Column, i: Column) -> Column:
        if eps == 0:
            return s * F.when(i == label, moved(c)).otherwise(c)
        weight = (1 - eps) * (i == label).cast("double") + eps / k
        return s * (weight * moved(c) + (1 - weight) * c)

    return F.transform(cosines, mixed)
