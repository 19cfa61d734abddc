"""Aggregations and evaluation (2.5)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import (
    FEAT4, FEATURES, NULLABLE, PAIRS, PRED3, PROBS_ALL, VIEWS, feat4, nullable, pairs, probs, views,
)
from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.functions.seeded import u
from tabprep.functions.text import word_count
from tabprep.functions.vectors import argmax
from tabprep.operators import clean, evaluate, profile, ranking
from tabprep.operators import vectors as vector_ops

_TOP = """top AS (SELECT vec_id, first, second FROM (SELECT vec_id, max(p) AS first,
  list_sort(list(p), 'DESC')[2] AS second FROM probs GROUP BY vec_id))"""


@query("class_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def class_counts(t: Tables):
    return profile.class_counts(t.embeddings, "label")


@query("class_count_profile", with_("c AS (SELECT event_type, count(*) AS n FROM events GROUP BY ALL)") + """
  SELECT (SELECT event_type FROM c ORDER BY n DESC, event_type LIMIT 1) AS largest, max(n) AS largest_n,
  (SELECT event_type FROM c ORDER BY n, event_type LIMIT 1) AS smallest, min(n) AS smallest_n,
  CAST(median(n) AS DOUBLE) AS median_n FROM c""")
def class_count_profile(t: Tables):
    return profile.class_count_profile(t.events, "event_type")


@query("class_tail_flag", "SELECT source, count(*) AS n, count(*) < 100 AS tail FROM documents GROUP BY source")
def class_tail_flag(t: Tables):
    return profile.class_tail_flag(t.documents, "source")


def _describe_sql(table: str, cols, probs) -> str:
    def one(c: str) -> str:
        cuts = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS p{round(p * 100)}" for p in probs)
        return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
          round(stddev_samp({c}), 4) AS std, min({c}) AS min, {cuts}, max({c}) AS max FROM {table}"""

    return "\nUNION ALL ".join(one(c) for c in cols)


def _rounded(df, probs):
    cuts = [f"p{round(p * 100)}" for p in probs]
    return df.select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
        *[F.round(c, 6).alias(c) for c in cuts], "max",
    )


_QUARTERS = (0.25, 0.5, 0.75)
# fixed values: the percentiles of the confidence profile
_NINE = (0.05, 0.25, 0.35, 0.45, 0.5, 0.65, 0.75, 0.95)


@query("describe", with_(FEAT4) + _describe_sql("feat4", FEATURES, _QUARTERS))
def describe(t: Tables):
    return _rounded(profile.describe(feat4(t), FEATURES, _QUARTERS), _QUARTERS)


@query("describe_percentiles", with_(PROBS_ALL, _TOP, "t6 AS (SELECT round(first, 6) AS first, round(second, 6) AS second FROM top)")
       + _describe_sql("t6", ["first", "second"], _NINE))
def describe_percentiles(t: Tables):
    top = ranking.top2(probs(t).select("vec_id", "probs"), "probs")
    scores = top.select(F.round("first", 6).alias("first"), F.round("second", 6).alias("second"))
    return _rounded(profile.describe(scores, ["first", "second"], _NINE), _NINE)


@query("trust_threshold", with_(PROBS_ALL, _TOP, "b AS (SELECT avg(first) - stddev_samp(first) / 2 AS t FROM top)") + """
  SELECT vec_id, round(first, 6) AS first, round(t, 6) AS threshold, first >= t AS trusted FROM top, b""")
def trust_threshold(t: Tables):
    top = ranking.top2(probs(t).select("vec_id", "probs"), "probs").select("vec_id", "first")
    flagged = profile.trust_threshold(top, "first")
    return flagged.select("vec_id", F.round("first", 6).alias("first"), F.round("threshold", 6).alias("threshold"), "trusted")


@query("majority_class", "SELECT label FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 1")
def majority_class(t: Tables):
    return clean.most_frequent(t.embeddings, "label")


@query("distinct_labels", """SELECT event_type, count(*) AS n, (SELECT count(DISTINCT event_type) FROM events) AS labels
  FROM events GROUP BY event_type""")
def distinct_labels(t: Tables):
    labels = t.events.agg(F.count_distinct("event_type")).scalar()
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("labels", labels)


@query("accuracy", with_(PRED3) + "SELECT round(avg(CAST(label = prediction AS INTEGER)), 9) AS accuracy FROM p1")
def accuracy(t: Tables):
    return evaluate.accuracy(_view1(t)).select(F.round("accuracy", 9).alias("accuracy"))


def _view1(t: Tables):
    return views(t).filter("view = 1").select("vec_id", "label", argmax(F.col("probs")).alias("prediction"))


@query("confusion_matrix", with_(PRED3, "k AS (SELECT label AS c FROM p1 UNION SELECT prediction FROM p1)") + """
  SELECT CAST(a.c AS INTEGER) AS actual, CAST(b.c AS INTEGER) AS predicted, count(p1.vec_id) AS n FROM k a CROSS JOIN k b
  LEFT JOIN p1 ON p1.label = a.c AND p1.prediction = b.c GROUP BY ALL""")
def confusion_matrix(t: Tables):
    return evaluate.confusion_matrix(_view1(t))


@query("classification_report", with_(PRED3, "k AS (SELECT label AS c FROM p1 UNION SELECT prediction FROM p1)", """
m AS (SELECT c, (SELECT count(*) FROM p1 WHERE label = c) AS support, (SELECT count(*) FROM p1 WHERE prediction = c) AS p,
  (SELECT count(*) FROM p1 WHERE prediction = c AND label = c) AS t FROM k),
r AS (SELECT c, support, t, CASE WHEN p > 0 THEN t / p ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN t / support ELSE 0 END AS recall FROM m),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r),
o AS (SELECT CAST(c AS VARCHAR) AS label, precision, recall, f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, sum(t) / sum(support), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)""") + """
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM o""")
def classification_report(t: Tables):
    r = evaluate.classification_report(_view1(t))
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("cross_entropy", with_(PROBS_ALL, """
l AS (SELECT vec_id, -ln(p) AS loss, (row_number() OVER (ORDER BY vec_id) - 1) // 48 AS batch_id
  FROM probs WHERE class = label),
b AS (SELECT batch_id, avg(loss) AS m FROM l GROUP BY ALL)""") + """
  SELECT round((SELECT avg(m) FROM b), 6) AS batch_loss, round((SELECT avg(loss) FROM l), 6) AS row_loss""")
def cross_entropy(t: Tables):
    logits = probs(t).select("vec_id", "label", F.transform("probs", lambda p: F.log(p)).alias("logits"))
    loss = evaluate.cross_entropy(logits, "vec_id", "logits", "label", batch=48)
    return loss.select(F.round("batch_loss", 6).alias("batch_loss"), F.round("row_loss", 6).alias("row_loss"))


@query("repeat_run_stats", with_(PRED3, f"""
runs AS (SELECT r.run, avg(CAST(label = prediction AS INTEGER)) AS a FROM p1, (SELECT unnest(range(10)) AS run) r
  WHERE {u_sql(42, 'vec_id', 'r.run')} < 0.5 GROUP BY r.run)""") + """
  SELECT round(avg(a), 9) AS mean_accuracy, round(stddev_pop(a), 9) AS std_accuracy FROM runs""")
def repeat_run_stats(t: Tables):
    runs = _view1(t).select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("run"))
    tested = runs.filter(u(42, F.col("vec_id"), F.col("run")) < 0.5)
    s = evaluate.repeat_run_stats(tested, "run")
    return s.select(*[F.round(c, 9).alias(c) for c in ("mean_accuracy", "std_accuracy")])


_AUG = f"""aug AS (SELECT doc_id, CASE WHEN {u_sql(7, 'doc_id', "'aug'")} < 0.3 THEN concat(text, ' and so on')
  ELSE text END AS text FROM documents WHERE lang = 'en')"""


@query("augmentation_delta", with_(_AUG) + """SELECT (SELECT count(*) FROM documents) AS original_rows,
  (SELECT count(*) FROM aug) AS augmented_rows,
  (SELECT count(*) FROM aug a WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.text = a.text)) AS new_rows""")
def augmentation_delta(t: Tables):
    longer = F.when(u(7, F.col("doc_id"), "aug") < 0.3, F.concat("text", F.lit(" and so on"))).otherwise(F.col("text"))
    augmented = t.documents.filter("lang = 'en'").select("doc_id", longer.alias("text"))
    return profile.augmentation_delta(t.documents, augmented, "text", "doc_id")


_WORDS = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> ''))"
_LENGTHS = f"""lens AS (SELECT unnest(['premise', 'hypothesis']) AS "column",
  unnest([{_WORDS.format('premise')}, {_WORDS.format('hypothesis')}]) AS value FROM pairs),
q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM lens GROUP BY ALL),
flag AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lens JOIN q USING ("column"))"""


@query("text_length_box", with_(PAIRS, _LENGTHS) + """SELECT "column", CAST(max(q1) AS DOUBLE) AS q1,
  CAST(max(median) AS DOUBLE) AS median, CAST(max(q3) AS DOUBLE) AS q3,
  CAST(min(value) FILTER (inside) AS DOUBLE) AS whisker_low, CAST(max(value) FILTER (inside) AS DOUBLE) AS whisker_high,
  CAST(count_if(NOT inside) AS BIGINT) AS outliers FROM flag GROUP BY ALL""")
def text_length_box(t: Tables):
    cols = ["premise", "hypothesis"]
    lengths = pairs(t).select(*[word_count(F.col(c)).alias(c) for c in cols])
    return profile.box_summary(lengths, cols)


@query("histogram", """WITH e AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM documents),
  b AS (SELECT CAST(least(floor((n_chars - lo) * 20 / (hi - lo)), 19) AS INTEGER) AS bin FROM documents, e)
  SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / 20), 6) AS lo,
  round(lo + (g.bin + 1) * ((hi - lo) / 20), 6) AS hi, count(b.bin) AS n
  FROM (SELECT unnest(range(20)) AS bin) g CROSS JOIN e LEFT JOIN b ON b.bin = g.bin GROUP BY ALL""")
def histogram(t: Tables):
    h = profile.histogram(t.documents, "n_chars", 20)
    return h.select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@query("density", """WITH s AS (SELECT count(*) AS n, pow(count(*), -0.2) * stddev_samp(p_retailprice) AS h,
  min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
  g AS (SELECT CAST(point AS INTEGER) AS point, lo + point * ((hi - lo) / 199) AS x, n, h
    FROM (SELECT unnest(range(200)) AS point), s)
  SELECT point, round(x, 6) AS x, round(sum(exp(-pow((x - p_retailprice) / h, 2) / 2)) / max(n * h * sqrt(2 * pi())), 9) AS density
  FROM g, part GROUP BY point, x""")
def density(t: Tables):
    d = profile.density(t.part, "p_retailprice", 200)
    return d.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query("minmax_fit", with_(FEAT4) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", min({c}) AS lo, max({c}) AS hi FROM feat4""" for c in FEATURES))
def minmax_fit(t: Tables):
    return vector_ops.minmax_fit(feat4(t), FEATURES)
