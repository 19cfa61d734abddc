"""Vector and score functions (2.9)."""

import math

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import (
    COLUMNS, COS, CVEC, PROBS_ALL, VEC, VIEWS, VLONG, WIDE, class_vec, probs, vec, views, wide,
)
from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.functions import vectors as V
from tabprep.functions.arrays import elements
from tabprep.functions.seeded import u
from tabprep.operators import vectors as vector_ops

_COSINES = ",\n".join([VEC, VLONG, CVEC, COS])


def long(df, array, value="value", places=6, keep=("vec_id",), pos="pos"):
    """One row per array element, rounded; -0.0 becomes 0.0."""
    out = elements(df, keep, array, value, pos)
    return out.withColumn(value, F.round(value, places) + F.lit(0.0))


# fitted on the rows of half the keys, applied to all: values outside [0, 1] stay
_HALF = u_sql(42, "vec_id", "'half'") + " < 0.5"


_BOUNDS = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in COLUMNS)
_SCALED = ", ".join(f"round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 6) AS {c}" for c in COLUMNS)


@query("minmax_scale", with_(WIDE, f"b AS (SELECT {_BOUNDS} FROM wide WHERE {_HALF})") + f"SELECT vec_id, {_SCALED} FROM wide, b")
def minmax_scale(t: Tables):
    df = wide(t)
    scaled = vector_ops.minmax_scale(df, COLUMNS, fit=df.filter(u(42, F.col("vec_id"), "half") < 0.5))
    return scaled.select("vec_id", *[F.round(c, 6).alias(c) for c in COLUMNS])


@query("one_hot", """SELECT vec_id, CAST(unnest(range(10)) AS INTEGER) AS pos,
  CAST(unnest(range(10)) = label AS DOUBLE) AS value FROM embeddings""")
def one_hot(t: Tables):
    return long(vec(t), V.one_hot(F.col("label"), 10))


@query("label_smooth", """SELECT vec_id, CAST(unnest(range(10)) AS INTEGER) AS pos,
  round(0.9 * CAST(unnest(range(10)) = label AS DOUBLE) + 0.1 / 10, 6) AS value FROM embeddings""")
def label_smooth(t: Tables):
    return long(vec(t), V.label_smooth(V.one_hot(F.col("label"), 10), 0.1, 10))


_POS = "CAST(pos AS INTEGER) AS pos"


@query("sigmoid", with_(VEC, VLONG) + f"SELECT vec_id, {_POS}, round(1 / (1 + exp(-x)), 6) AS value FROM vlong")
def sigmoid(t: Tables):
    return long(vec(t), V.sigmoid(F.col("v")))


@query("relu", with_(VEC, VLONG) + f"SELECT vec_id, {_POS}, round(greatest(x, 0), 6) AS value FROM vlong")
def relu(t: Tables):
    return long(vec(t), V.relu(F.col("v")))


@query("softmax", with_(VEC, VLONG, "e AS (SELECT *, exp(x - max(x) OVER (PARTITION BY vec_id)) AS ex FROM vlong)")
       + f"SELECT vec_id, {_POS}, round(ex / sum(ex) OVER (PARTITION BY vec_id), 9) AS value FROM e")
def softmax(t: Tables):
    return long(vec(t), V.softmax(F.col("v")), places=9)


@query("l2_normalize", with_(VEC, VLONG) + f"""SELECT vec_id, {_POS},
  round(x / greatest(sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 1e-12), 6) + 0.0 AS value FROM vlong""")
def l2_normalize(t: Tables):
    return long(vec(t), V.l2_normalize(F.col("v")))


@query("cosine_scores", with_(_COSINES) + "SELECT vec_id, CAST(class AS INTEGER) AS class, round(c, 6) + 0.0 AS score FROM cos")
def cosine_scores(t: Tables):
    scored = vector_ops.cosine_scores(vec(t), F.col("v"), V.class_matrix(class_vec(t)))
    return long(scored, "cosines", "score", pos="class")


@query("class_probabilities", with_(PROBS_ALL) + "SELECT vec_id, CAST(class AS INTEGER) AS class, round(p, 6) AS p FROM probs")
def class_probabilities(t: Tables):
    return long(probs(t), "probs", "p", pos="class")


_C, _S, _TH, _MM = math.cos(0.5), math.sin(0.5), math.cos(math.pi - 0.5), math.sin(math.pi - 0.5) * 0.5
_PHI = f"(c * {_C!r} - sqrt(greatest(1 - c * c, 0)) * {_S!r})"


def _margin_sql(moved: str) -> str:
    return with_(_COSINES) + f"""SELECT vec_id, CAST(class AS INTEGER) AS class,
      round(30 * CASE WHEN class = label THEN {moved} ELSE c END, 6) + 0.0 AS value FROM cos"""


def _margin(t: Tables, **options):
    scored = vector_ops.cosine_scores(vec(t), F.col("v"), V.class_matrix(class_vec(t)))
    return long(scored, V.arc_margin(F.col("cosines"), F.col("label"), 30.0, 0.5, **options), pos="class")


@query("arc_margin", _margin_sql(f"(CASE WHEN c > {_TH!r} THEN {_PHI} ELSE c - {_MM!r} END)"))
def arc_margin(t: Tables):
    return _margin(t)


@query("arc_margin_easy", _margin_sql(f"(CASE WHEN c > 0 THEN {_PHI} ELSE c END)"))
def arc_margin_easy(t: Tables):
    return _margin(t, easy=True)


# fixed weights by a rule: all inputs, 3 hidden units, 2 outputs
W1 = [[((7 * i + 13 * j) % 17 - 8) / 8 for i in range(len(COLUMNS))] for j in range(3)]
B1 = [0.1, -0.2, 0.0]
W2 = [[1.5, -2.0, 0.5], [-1.0, 1.0, 2.0]]
B2 = [0.05, -0.3]


def mlp_sql() -> str:
    def lin(w, b, names):
        return " + ".join(f"({x!r}) * {n}" for x, n in zip(w, names)) + f" + ({b!r})"

    hidden = ", ".join(f"1 / (1 + exp(-({lin(w, b, COLUMNS)}))) AS h{i}" for i, (w, b) in enumerate(zip(W1, B1)))
    out = ", ".join(f"{lin(w, b, ['h0', 'h1', 'h2'])} AS z{i}" for i, (w, b) in enumerate(zip(W2, B2)))
    return with_(WIDE, f"h AS (SELECT vec_id, {hidden} FROM wide)", f"z AS (SELECT vec_id, {out} FROM h)") + """
      SELECT vec_id, round(1 / (1 + exp(z1 - z0)), 6) AS p0, round(1 / (1 + exp(z0 - z1)), 6) AS p1,
      CASE WHEN z0 >= z1 THEN 0 ELSE 1 END AS prediction FROM z"""


@query("mlp_forward", mlp_sql())
def mlp_forward(t: Tables):
    x = F.array(*COLUMNS)
    weights = (V.matrix(W1), F.array(*map(F.lit, B1)), V.matrix(W2), F.array(*map(F.lit, B2)))
    out = vector_ops.mlp_forward(wide(t), x, *weights)
    p = F.col("probs")
    return out.select("vec_id", F.round(p[0], 6).alias("p0"), F.round(p[1], 6).alias("p1"), "prediction")


@query("pool_vectors", with_(VEC, VLONG, """
  pooled AS (SELECT label, pos, avg(x) AS value FROM vlong GROUP BY ALL
    UNION ALL SELECT label, pos + 64, max(x) FROM vlong GROUP BY ALL)""") + f"SELECT label, {_POS}, round(value, 6) + 0.0 AS value FROM pooled")
def pool_vectors(t: Tables):
    return long(vector_ops.pool_vectors(vec(t), "label", "v"), "pooled", keep=("label",))


@query("view_average", with_(VIEWS, "a AS (SELECT vec_id, class, avg(p) AS p FROM views GROUP BY ALL)") + """
  SELECT vec_id, CAST(class AS INTEGER) AS prediction, round(p, 6) AS p FROM a
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) = 1""")
def view_average(t: Tables):
    mean = vector_ops.view_average(views(t), "vec_id")
    return mean.select("vec_id", "prediction", F.round(F.array_max("probs"), 6).alias("p"))


# fixed values: channel means and deviations of the image preparation
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
_M, _D = f"list_value{MEAN}[1 + pos % 3]", f"list_value{STD}[1 + pos % 3]"


@query("standardize_channels", with_(VEC, VLONG) + f"SELECT vec_id, {_POS}, round((x - {_M}) / {_D}, 6) + 0.0 AS value FROM vlong")
def standardize_channels(t: Tables):
    return long(vec(t), V.standardize(F.col("v"), MEAN, STD))


@query("unstandardize", with_(VEC, VLONG) + f"""SELECT vec_id, {_POS},
  round(least(greatest(x * {_D} + {_M}, 0), 1), 6) + 0.0 AS value FROM vlong""")
def unstandardize(t: Tables):
    return long(vec(t), V.unstandardize(F.col("v"), MEAN, STD))
