"""Inputs derived from the given tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.catalog.registry import Tables, u_sql
from tabprep.functions.seeded import u
from tabprep.functions.text import words
from tabprep.functions.vectors import argmax, class_matrix
from tabprep.operators.vectors import class_probabilities, summaries
from tabprep.session import cut

FEATURES = ["quantity", "extendedprice", "discount", "tax"]


def feat4(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.spread("lineitem", "l_orderkey").select(
        *[F.col(f"l_{f}").alias(f) for f in FEATURES],
        F.when(flag == "A", 0).when(flag == "N", 1).when(flag == "R", 2).alias("label"),
    )


FEAT4 = """feat4 AS (SELECT l_quantity AS quantity, l_extendedprice AS extendedprice, l_discount AS discount,
  l_tax AS tax, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS label FROM lineitem)"""

FEAT4_LONG = """long AS (SELECT 0 AS feature_no, 'quantity' AS feature, quantity AS value, label FROM feat4
  UNION ALL SELECT 1, 'extendedprice', extendedprice, label FROM feat4
  UNION ALL SELECT 2, 'discount', discount, label FROM feat4
  UNION ALL SELECT 3, 'tax', tax, label FROM feat4)"""


def vec(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


VEC = "vec AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
VLONG = "vlong AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM vec)"


def vec4(t: Tables) -> DataFrame:
    v = F.col("embedding")
    return t.embeddings.select("vec_id", *[v[i].cast("double").alias(f"f{i + 1}") for i in range(4)], "label")


VEC4 = """vec4 AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS f1, CAST(embedding[2] AS DOUBLE) AS f2,
  CAST(embedding[3] AS DOUBLE) AS f3, CAST(embedding[4] AS DOUBLE) AS f4, label FROM embeddings)"""


#: All numbers of a vector as columns.
WIDTH = 64
COLUMNS = [f"f{i + 1}" for i in range(WIDTH)]


def wide(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(COLUMNS)], "label")


WIDE = f"wide AS (SELECT vec_id, {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS {c}' for i, c in enumerate(COLUMNS))}, label FROM embeddings)"


def texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text", "lang")


def nullable(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.when(u(42, k, "acctbal") >= 0.1, F.col("c_acctbal")).alias("acctbal"),
        F.when(u(42, k, "segment") >= 0.1, F.col("c_mktsegment")).alias("segment"),
        F.when(u(42, k, "nation") >= 0.3, F.col("c_nationkey")).alias("nationkey"),
    )


NULLABLE = f"""nullable AS (SELECT c_custkey,
  CASE WHEN {u_sql(42, 'c_custkey', "'acctbal'")} >= 0.1 THEN c_acctbal END AS acctbal,
  CASE WHEN {u_sql(42, 'c_custkey', "'segment'")} >= 0.1 THEN c_mktsegment END AS segment,
  CASE WHEN {u_sql(42, 'c_custkey', "'nation'")} >= 0.3 THEN c_nationkey END AS nationkey FROM customer)"""


def pairs(t: Tables) -> DataFrame:
    """User turn and the assistant's reply, with a label the texts can tell.

    0: the true reply; 1: the reply after that one; 2: the premise again. Equi-joins on
    (conv_id, turn), so one long conversation spreads over all tasks.
    """
    c = t.spread("conversations", "conv_id")
    first = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("premise"))
    replies = c.filter("role = 'assistant'")
    reply = replies.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    later = replies.select("conv_id", (F.col("turn") - 3).alias("turn"), F.col("text").alias("later"))
    draw = u(42, F.concat_ws("-", "conv_id", "turn"), "label")
    label = (
        F.when((draw >= 2 / 3), 2).when((draw >= 1 / 3) & F.col("later").isNotNull(), 1).otherwise(0)
    )
    return (
        first.join(reply, ["conv_id", "turn"])
        .join(later, ["conv_id", "turn"], "left")
        .withColumn("label", label)
        .select(
            F.concat_ws("-", "conv_id", "turn").alias("id"),
            "premise",
            F.when(F.col("label") == 0, F.col("reply"))
            .when(F.col("label") == 1, F.col("later"))
            .otherwise(F.col("premise"))
            .alias("hypothesis"),
            "label",
        )
    )


_PAIR_ID = "concat_ws('-', a.conv_id, a.turn)"
_PAIR_U = u_sql(42, _PAIR_ID, "'label'")
PAIRS = f"""raw_pairs AS (SELECT {_PAIR_ID} AS id, a.text AS premise, b.text AS reply, c.text AS later,
  CASE WHEN {_PAIR_U} >= 2.0/3 THEN 2 WHEN {_PAIR_U} >= 1.0/3 AND c.text IS NOT NULL THEN 1 ELSE 0 END AS label
  FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
  LEFT JOIN conversations c ON a.conv_id = c.conv_id AND c.turn = a.turn + 3 AND c.role = 'assistant'
  WHERE a.role = 'user'),
pairs AS (SELECT id, premise, CASE label WHEN 0 THEN reply WHEN 1 THEN later ELSE premise END AS hypothesis,
  label FROM raw_pairs)"""


def metric_log(t: Tables) -> DataFrame:
    """One metric per run and day: ``(run, epoch, metric)``."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("int")
    return t.events.groupBy(F.col("event_type").alias("run"), day.alias("epoch")).agg(
        F.round(F.avg("value"), 6).alias("metric")
    )


#: What a text looks like, as numbers; ``labels.quality`` can be told from them.
SIGNALS = ["distinct_words", "letters_a_word", "capitals", "digits", "marks", "log_words"]


def signals(t: Tables) -> DataFrame:
    """``(doc_id, label, *SIGNALS)`` of the labelled documents."""
    text = F.coalesce("text", F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    listed = words(text)
    many = F.greatest(F.size(listed), F.lit(1))

    def share(others: str):
        return F.length(F.regexp_replace(text, others, "")) / n

    found = [
        F.size(F.array_distinct(listed)) / many, F.length(F.array_join(listed, "")) / many,
        share("[^A-Z]"), share("[^0-9]"), share(r"[\p{L}0-9 ]"), F.log1p(F.size(listed)),
    ]
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    return t.spread("documents", "doc_id").join(labels, "doc_id").select("doc_id", "label", *[c.alias(s) for c, s in zip(found, SIGNALS, strict=True)])


METRIC_LOG = """metric_log AS (SELECT event_type AS run,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
  round(avg(value), 6) AS metric FROM events GROUP BY ALL)"""


def class_vec(t: Tables) -> DataFrame:
    """Mean vector per class, long ``(class, pos, w)``."""
    means = summaries(vec(t), "label", "v", "mean")
    return means.select(F.col("label").alias("class"), F.posexplode("mean").alias("pos", "w")).withColumn("w", F.round("w", 6))


CVEC = "cvec AS (SELECT label AS class, pos, round(avg(x), 6) AS w FROM vlong GROUP BY ALL)"


def probs(t: Tables) -> DataFrame:
    """``(vec_id, label, v, probs)``: softmax(30 * cosine) against the class means."""
    return class_probabilities(vec(t), F.col("v"), class_matrix(class_vec(t)))


COS = """cos AS (SELECT vec_id, l.label, class,
  sum(x * w) / (greatest(sqrt(sum(x * x)), 1e-12) * greatest(sqrt(sum(w * w)), 1e-12)) AS c
  FROM vlong l JOIN cvec USING (pos) GROUP BY ALL)"""
PROBS = """ex AS (SELECT *, exp(30 * c - max(30 * c) OVER (PARTITION BY vec_id)) AS e FROM cos),
probs AS (SELECT vec_id, label, class, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM ex)"""
PROBS_ALL = ",\n".join([VEC, VLONG, CVEC, COS, PROBS])

# fixed values: first position and length of the vector part each view looks at
VIEWS_AT = [(0, 0, 64), (1, 0, 32), (2, 32, 32)]


def views(t: Tables) -> DataFrame:
    """``(vec_id, label, view, probs)`` from three parts of each vector."""
    weights, out = cut(class_vec(t)), vec(t).select("vec_id", "label", "v")
    for view, start, length in VIEWS_AT:
        part = weights.filter(F.col("pos").between(start, start + length - 1))
        out = class_probabilities(out, F.slice("v", start + 1, length), class_matrix(part), out=f"p{view}")
    rows = F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"p{v}").alias("probs")) for v, _, _ in VIEWS_AT])
    return out.select("vec_id", "label", F.inline(rows))


VIEWS = ",\n".join([VEC, VLONG, CVEC]) + """,
vw AS (SELECT * FROM (VALUES (0, 0, 63), (1, 0, 31), (2, 32, 63)) t(view, lo, hi)),
vcos AS (SELECT vec_id, l.label, view, class,
  sum(x * w) / (greatest(sqrt(sum(x * x)), 1e-12) * greatest(sqrt(sum(w * w)), 1e-12)) AS c
  FROM vlong l JOIN cvec USING (pos) JOIN vw ON pos BETWEEN lo AND hi GROUP BY ALL),
vex AS (SELECT *, exp(30 * c - max(30 * c) OVER (PARTITION BY vec_id, view)) AS e FROM vcos),
views AS (SELECT vec_id, label, view, class, e / sum(e) OVER (PARTITION BY vec_id, view) AS p FROM vex)"""


def pred3(t: Tables) -> dict[str, DataFrame]:
    """Three result tables ``(vec_id, label, prediction)`` of the same samples."""
    v = cut(views(t))  # read three times below
    return {
        f"p{i}": v.filter(F.col("view") == i).select("vec_id", "label", argmax(F.col("probs")).alias("prediction"))
        for i, _, _ in VIEWS_AT
    }


PRED3 = VIEWS + """,
best AS (SELECT vec_id, label, view, class AS prediction FROM views
  QUALIFY row_number() OVER (PARTITION BY vec_id, view ORDER BY p DESC, class) = 1),
p0 AS (SELECT vec_id, label, prediction FROM best WHERE view = 0),
p1 AS (SELECT vec_id, label, prediction FROM best WHERE view = 1),
p2 AS (SELECT vec_id, label, prediction FROM best WHERE view = 2)"""
