"""Scans (2.1) and sinks (2.2) as round trips through the shared folder."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import COLUMNS, PRED3, PROBS_ALL, WIDE, pred3, probs, wide
from tabprep.catalog.registry import Tables, query, with_
from tabprep.functions.arrays import elements
from tabprep.functions.text import words
from tabprep.operators import clean, ranking
from tabprep.session import scratch_path
from tabprep.sources import readers, writers

_DOCS = "doc_id BIGINT, text STRING, lang STRING"


@query("scan_csv", "SELECT doc_id, text, lang FROM documents")
def scan_csv(t: Tables):
    path = scratch_path(t.spark, "documents.csv")
    writers.write_csv(t.documents.select("doc_id", "text", "lang"), path)
    return readers.read_csv(t.spark, path, _DOCS)


_PART = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"


@query("scan_csv_indexed", "SELECT p_partkey, p_name, p_size FROM part")
def scan_csv_indexed(t: Tables):
    path = scratch_path(t.spark, "part.csv")
    writers.write_csv_keyed(t.part, path, "p_partkey")
    return readers.read_csv(t.spark, path, _PART, multiline=False).select("p_partkey", "p_name", "p_size")


def _as_text(t: Tables, separator: str, head: str | None = None, tail: str | None = None):
    """Embeddings and their labels as lines of numbers, with optional bracket lines."""
    df = wide(t)
    cells = [F.col(c).cast("string") for c in (*COLUMNS, "label")]
    lines = df.select(F.concat(F.concat_ws(separator, *cells), F.lit(" ")).alias("value"))
    for extra in filter(None, (head, tail)):
        lines = lines.unionByName(t.spark.range(1).select(F.lit(extra).alias("value")))
    path = scratch_path(t.spark, "matrix.txt")
    lines.write.text(path)
    return readers.read_matrix(t.spark, path)


def _matrix_columns(df):
    x = F.col("features")
    return df.select(*[x[i].alias(c) for i, c in enumerate(COLUMNS)], "label")


_MATRIX = with_(WIDE) + f"SELECT {', '.join(COLUMNS)}, label FROM wide"


@query("scan_bracketed_matrix", _MATRIX)
def scan_bracketed_matrix(t: Tables):
    return _matrix_columns(_as_text(t, "\t", "traindata=[", "];"))


@query("scan_matrix", _MATRIX)
def scan_matrix(t: Tables):
    return _matrix_columns(_as_text(t, " "))


_PROBS = with_(PROBS_ALL) + "SELECT vec_id, CAST(class AS INTEGER) AS class, round(p, 6) AS p FROM probs"


def _stored(t: Tables):
    path = scratch_path(t.spark, "probs.parquet")
    writers.write_probabilities(probs(t).select("vec_id", "probs"), path)
    return path


@query("scan_prob_matrix", _PROBS)
def scan_prob_matrix(t: Tables):
    stored = readers.read_probabilities(t.spark, _stored(t))
    return elements(stored, ["vec_id"], "probs", "p", "class").withColumn("p", F.round("p", 6))


@query("sink_prob_matrix", with_(PROBS_ALL) + """SELECT vec_id, CAST(count(*) AS INTEGER) AS classes,
  round(sum(p), 6) AS total FROM probs GROUP BY vec_id""")
def sink_prob_matrix(t: Tables):
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    stored = t.spark.read.parquet(_stored(t))
    return stored.select("vec_id", F.size("probs").alias("classes"), F.round(total, 6).alias("total"))


@query("sink_csv", "SELECT * FROM part")
def sink_csv(t: Tables):
    path = scratch_path(t.spark, "part.csv")
    writers.write_csv(t.part, path)
    return readers.read_csv(t.spark, path, _PART)


@query("sink_csv_keyed", "SELECT c_custkey, c_nationkey, c_name FROM customer")
def sink_csv_keyed(t: Tables):
    path = scratch_path(t.spark, "customer.csv")
    writers.write_csv_keyed(t.customer.select("c_nationkey", "c_name", "c_custkey"), path, "c_custkey")
    return readers.read_csv(t.spark, path, "c_custkey BIGINT, c_nationkey INT, c_name STRING")


@query("sink_passthrough", with_(PRED3) + "SELECT vec_id, prediction FROM p0")
def sink_passthrough(t: Tables):
    schema = "vec_id BIGINT, prediction INT"
    source, target = scratch_path(t.spark, "submission.csv"), scratch_path(t.spark, "published.csv")
    writers.write_csv(pred3(t)["p0"].select("vec_id", "prediction"), source)
    writers.publish_csv(t.spark, source, target, schema)
    return readers.read_csv(t.spark, target, schema)


@query("sink_pair_log", r"""SELECT concat(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '[\r\n]+', ' ', 'g'), '|||',
  array_to_string(list_reverse(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')), ' ')) AS value FROM conversations""")
def sink_pair_log(t: Tables):
    path = scratch_path(t.spark, "pairs.log")
    rewritten = t.conversations.select("text", F.array_join(F.reverse(words(F.col("text"))), " ").alias("rewritten"))
    writers.write_pair_log(rewritten, path, "text", "rewritten")
    return t.spark.read.text(path)


@query("submission_job", with_(PROBS_ALL, """dict AS (SELECT n_nationkey AS class, n_name FROM nation),
top AS (SELECT vec_id, class FROM probs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) = 1)""")
       + "SELECT concat('img', vec_id, '.png') AS filename, n_name AS cultivar FROM top LEFT JOIN dict USING (class)")
def submission_job(t: Tables):
    """Rank, decode the best class, write (key, label) and read it back."""
    ranks = ranking.rank_scores(probs(t).select("vec_id", "probs"), "probs")
    names = t.nation.select(F.col("n_nationkey").alias("label_index"), F.col("n_name").alias("cultivar"))
    best = ranks.filter("rank = 1").select(
        F.concat(F.lit("img"), "vec_id", F.lit(".png")).alias("filename"), F.col("class").alias("label_index")
    )
    path = scratch_path(t.spark, "submission.csv")
    decoded = clean.label_decode(best, names, F.col("filename"))
    writers.write_csv_keyed(decoded.select("cultivar", "filename"), path, "filename")
    return readers.read_csv(t.spark, path, "filename STRING, cultivar STRING")
