"""Orders, ranks, batches and folds (2.6)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import METRIC_LOG, PROBS_ALL, VIEWS, metric_log, probs, views
from tabprep.catalog.registry import Tables, query, with_
from tabprep.functions.vectors import argmax
from tabprep.operators import ranking
from tabprep.operators.prefix import with_ordinal


@query("sort_desc", """SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey""")
def sort_desc(t: Tables):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey")


@query("rank_scores", with_(PROBS_ALL) + """SELECT vec_id, CAST(row_number() OVER
  (PARTITION BY vec_id ORDER BY p DESC, class) AS INTEGER) AS rank, CAST(class AS INTEGER) AS class, round(p, 6) AS score FROM probs""")
def rank_scores(t: Tables):
    ranks = ranking.rank_scores(probs(t).select("vec_id", "probs"), "probs")
    return ranks.select("vec_id", "rank", "class", F.round("score", 6).alias("score"))


@query("top2_margin", with_(PROBS_ALL, "s AS (SELECT vec_id, list_sort(list(p), 'DESC') AS l FROM probs GROUP BY vec_id)")
       + "SELECT vec_id, round(l[1], 6) AS first, round(l[2], 6) AS second, round(l[1] - l[2], 6) AS margin FROM s")
def top2_margin(t: Tables):
    top = ranking.top2(probs(t).select("vec_id", "probs"), "probs")
    return top.select("vec_id", *[F.round(c, 6).alias(c) for c in ("first", "second", "margin")])


@query("argmax_class", with_(VIEWS) + """SELECT vec_id, CAST(view AS INTEGER) AS view, CAST(class AS INTEGER) AS prediction
  FROM views QUALIFY row_number() OVER (PARTITION BY vec_id, view ORDER BY p DESC, class) = 1""")
def argmax_class(t: Tables):
    return views(t).select("vec_id", "view", argmax(F.col("probs")).alias("prediction"))


@query("row_ordinal", "SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) AS ordinal FROM documents")
def row_ordinal(t: Tables):
    return with_ordinal(t.documents.select("doc_id", "source"), "source", "doc_id")


@query("batch_assign", """SELECT doc_id, batch_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch_id
  FROM documents) WHERE batch_id < (SELECT count(*) // 32 FROM documents)""")
def batch_assign(t: Tables):
    return ranking.with_batch(t.documents.select("doc_id"), "doc_id", size=32, drop_last=True)


def _fold_sql(patience: int, delta: float, mode: str, reset: bool, out: str) -> str:
    sign = 1 if mode == "min" else -1
    better = f"{sign} * m.metric < {sign} * s.best - {delta}"
    kept = "0" if reset else "s.waited"
    return f"""WITH RECURSIVE {METRIC_LOG},
    m AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i FROM metric_log),
    s AS (SELECT run, i, metric AS best, epoch AS best_epoch, 0 AS waited, CAST(NULL AS INTEGER) AS stop_epoch FROM m WHERE i = 1
      UNION ALL SELECT m.run, m.i, CASE WHEN {better} THEN m.metric ELSE s.best END,
        CASE WHEN {better} THEN m.epoch ELSE s.best_epoch END,
        CASE WHEN {better} THEN {kept} ELSE s.waited + 1 END,
        CASE WHEN NOT ({better}) AND s.waited + 1 >= {patience} THEN m.epoch END
      FROM s JOIN m ON m.run = s.run AND m.i = s.i + 1 WHERE s.stop_epoch IS NULL)
    SELECT {out} FROM s QUALIFY row_number() OVER (PARTITION BY run ORDER BY i DESC) = 1"""


@query("early_stop", _fold_sql(3, 0.001, "min", True, "run, best, best_epoch, stop_epoch"))
def early_stop(t: Tables):
    return ranking.early_stop(metric_log(t), "run", "epoch", "metric", patience=3, delta=0.001)


@query("early_stop_max", _fold_sql(8, 0.001, "max", True, "run, best, best_epoch, stop_epoch"))
def early_stop_max(t: Tables):
    return ranking.early_stop(metric_log(t), "run", "epoch", "metric", patience=8, delta=0.001, mode="max")


@query("early_stop_no_reset", _fold_sql(4, 0.0, "min", False, "run, best, best_epoch, stop_epoch"))
def early_stop_no_reset(t: Tables):
    return ranking.early_stop(metric_log(t), "run", "epoch", "metric", patience=4, delta=0.0, reset_counter=False)


@query("best_checkpoint", _fold_sql(5, 0.001, "min", True, "run, best_epoch"))
def best_checkpoint(t: Tables):
    stopped = ranking.early_stop(metric_log(t), "run", "epoch", "metric", patience=5, delta=0.001)
    return stopped.select("run", "best_epoch")
