"""Learners (2.11) and the model sink (2.2).

Fits are iterative, so SQL states what must hold of their output: which rows are test rows,
that each row's probabilities sum to one and the prediction is their largest, and, in one
row with key -1 (or an empty id), the number of training rows and that the accuracy on the test
rows, which nothing was fitted on, reaches a bound. What is learnt is the quality of labelled
documents, from numbers that tell of their texts (about 86 in 100 are good).
"""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import COLUMNS, FEAT4, FEATURES, PAIRS, SIGNALS, feat4, pairs, signals, vec, wide
from tabprep.catalog.registry import Tables, query, with_
from tabprep.catalog.sampling import _order
from tabprep.catalog.trees import _DEPTH, _fit_sql
from tabprep.catalog.vectors import B1, B2, W1, W2, mlp_sql
from tabprep.functions.vectors import total
from tabprep.operators import evaluate, sampling
from tabprep.operators import vectors as vector_ops
from tabprep.plans import external, models, tree
from tabprep.session import address, cut, scratch_path


def _parts(df, key, seed=42):
    """Training and test rows, materialised because a fit reads them many times."""
    split = cut(sampling.split_seeded(df, key, 0.2, seed))
    return split.filter("part = 'train'"), split.filter("part = 'test'")


def _sound():
    p = F.col("probs")
    return ((F.abs(total(p) - 1) < 1e-6) & (F.get(p, F.col("prediction")) == F.array_max(p))).alias("sound")


def _told(train, test, model, key: str, none, bound: float):
    """The test rows' check, and in one row the number of training rows and whether the test accuracy reaches a bound."""
    scored = cut(models.score_batch(test, model, [key, "label"]))
    rows = scored.select(key, "label", _sound())
    reached = scored.agg((F.avg(evaluate.hit("label", "prediction")) >= bound).alias("sound")).scalar()
    share = train.agg(F.count(F.lit(1)).cast("int").alias("label")).select(F.lit(none).alias(key), "label", reached.alias("sound"))
    return rows.unionByName(share)


def _told_sql(src: str, key: str, none: str) -> str:
    split = f"(SELECT {key}, label, {_order('split', key)} <= ceil(0.2 * count(*) OVER ()) AS test FROM {src})"
    return f"""SELECT {key}, CAST(label AS INTEGER) AS label, true AS sound FROM {split} WHERE test
      UNION ALL SELECT {none}, CAST(count(*) AS INTEGER), true FROM {split} WHERE NOT test"""


_SIGNAL_SQL = _told_sql("(SELECT doc_id, quality AS label FROM documents JOIN labels USING (doc_id))", "doc_id", "-1")


def _scaled(df, key: str, columns: list[str]):
    train, test = _parts(df, key)
    return cut(vector_ops.minmax_scale(train, columns)), cut(vector_ops.minmax_scale(test, columns, fit=train))


@query("tree_fit", _SIGNAL_SQL)
def tree_fit(t: Tables):
    train, test = _parts(signals(t), "doc_id")
    return _told(train, test, models.tree_fit(train, SIGNALS, "label"), "doc_id", -1, 0.9)


@query("mlp_fit", _SIGNAL_SQL)
def mlp_fit(t: Tables):
    train, test = _scaled(signals(t), "doc_id", SIGNALS)
    return _told(train, test, models.mlp_fit(train, SIGNALS, "label", 2), "doc_id", -1, 0.9)


@query("vector_classifier", _SIGNAL_SQL)
def vector_classifier(t: Tables):
    train, test = (models.with_vector(part.withColumn("v", F.array(*SIGNALS)), "v") for part in _scaled(signals(t), "doc_id", SIGNALS))
    return _told(train, test, models.vector_classifier(train, len(SIGNALS), "label", 2), "doc_id", -1, 0.9)


@query("pair_classifier", with_(PAIRS) + _told_sql("pairs", "id", "''"))
def pair_classifier(t: Tables):
    train, dev = _parts(models.pair_features(pairs(t)), "id")
    return _told(train, dev, models.pair_classifier(train), "id", "", 0.6)


@query("score_batch", "SELECT vec_id, true AS sound FROM embeddings")
def score_batch(t: Tables):
    """Every vector, scored by a stored model."""
    rows = models.with_vector(vec(t), "v")
    path = scratch_path(t.spark, "model")
    models.save_model(models.vector_classifier(cut(rows), 64, "label", 10), path)
    return models.score_batch(rows, models.load_model(path), ["vec_id"]).select("vec_id", _sound())


@query("score_external", mlp_sql())
def score_external(t: Tables):
    """Every vector, scored by stored weights that Spark does not know: the probabilities of ``mlp_forward``."""
    path = f"{scratch_path(t.spark, 'weights')}.npz"
    external.save_weights(t.spark, path, w1=W1, b1=B1, w2=W2, b2=B2)
    scored = external.score(vec(t), "v", external.perceptron(address(t.spark, path)), len(COLUMNS))
    p = F.col("probs")
    return scored.select("vec_id", F.round(p[0], 6).alias("p0"), F.round(p[1], 6).alias("p1"), "prediction")


@query("sink_model", f"SELECT vec_id, true AS same FROM (SELECT vec_id, {_order('split', 'vec_id')} <= ceil(0.2 * count(*) OVER ()) AS test FROM embeddings) WHERE test")
def sink_model(t: Tables):
    """Whether a model gives the same probabilities before saving and after loading."""
    train, test = _scaled(wide(t), "vec_id", COLUMNS)
    fitted = models.mlp_fit(train, COLUMNS, "label", 10, iterations=20)
    path = scratch_path(t.spark, "model")
    models.save_model(fitted, path)
    before = models.score_batch(test, fitted, ["vec_id"]).select("vec_id", F.col("probs").alias("before"))
    after = models.score_batch(test, models.load_model(path), ["vec_id"]).select("vec_id", F.col("probs").alias("after"))
    return before.join(after, "vec_id").select("vec_id", (F.col("before") == F.col("after")).alias("same"))


@query("sink_tree_table", with_(FEAT4, _fit_sql("feat4", FEATURES, [0, 1, 2], _DEPTH)) + """
  SELECT node_id, depth, feature, threshold, label, n FROM nodes""")
def sink_tree_table(t: Tables):
    """The exact tree, stored as its node table."""
    path = scratch_path(t.spark, "nodes.parquet")
    tree.id3_fit(feat4(t), FEATURES, "label", _DEPTH).write.parquet(path)
    return t.spark.read.parquet(path).select("node_id", "depth", "feature", "threshold", "label", "n")
