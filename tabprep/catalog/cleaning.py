"""Projections, filters, null handling, label dictionaries (2.3) and joins (2.4)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import NULLABLE, PRED3, nullable, pred3
from tabprep.catalog.registry import Tables, query, with_
from tabprep.operators import clean, evaluate, joins


@query("project_columns", "SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem")
def project_columns(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


@query("drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def drop_columns(t: Tables):
    return t.part.drop("p_name", "p_type")


@query("feature_label_split", """SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS label, 3 AS n_features,
  l_quantity AS f1, l_discount AS f2, l_tax AS f3 FROM lineitem""")
def feature_label_split(t: Tables):
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    split = clean.feature_label_split(t.lineitem, cols, keep=["l_orderkey"])
    x = F.col("features")
    return split.select(
        "l_orderkey", "label", F.size(x).alias("n_features"), x[0].alias("f1"), x[1].alias("f2"), x[2].alias("f3")
    )


@query("cast_label", "SELECT vec_id, CAST(label AS INTEGER) AS label FROM embeddings")
def cast_label(t: Tables):
    return t.embeddings.select("vec_id", F.col("label").cast("int").alias("label"))


@query("filter_not_equal", "SELECT event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'error'")
def filter_not_equal(t: Tables):
    return clean.filter_not_equal(t.events, "event_type", "error").select("event_id", "event_type")


@query("filter_equal", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def filter_equal(t: Tables):
    return t.documents.filter(F.col("lang") == "en").select("doc_id", "source")


@query("filter_extension", r"SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '\.(html|htm)$')")
def filter_extension(t: Tables):
    return t.pages.select("page_id", "url").filter(clean.has_suffix(F.col("url"), ("html", "htm")))


@query("filter_threshold", """SELECT l_returnflag, l_quantity <= 24.5 AS below, count(*) AS n
  FROM lineitem WHERE l_quantity <= 24.5 OR l_quantity > 24.5 GROUP BY ALL""")
def filter_threshold(t: Tables):
    left = t.lineitem.filter(F.col("l_quantity") <= 24.5)
    right = t.lineitem.filter(F.col("l_quantity") > 24.5)

    def size(df, below):
        return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).withColumn("below", F.lit(below))

    return size(left, True).unionByName(size(right, False))


@query("null_counts", with_("""joined AS (SELECT o_orderkey, o_totalprice, sum(l_quantity) AS qty, max(l_shipdate) AS shipped
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)""") + """
  SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS nulls FROM joined
  UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM joined
  UNION ALL SELECT 'qty', count(*) - count(qty) FROM joined
  UNION ALL SELECT 'shipped', count(*) - count(shipped) FROM joined""")
def null_counts(t: Tables):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.max("l_shipdate").alias("shipped")
    )
    joined = t.orders.select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left")
    return clean.null_counts(joined)


@query("table_info", with_(NULLABLE) + """
  SELECT 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey) AS non_null, count(*) AS rows FROM nullable
  UNION ALL SELECT 'acctbal', 'double', count(acctbal), count(*) FROM nullable
  UNION ALL SELECT 'segment', 'string', count(segment), count(*) FROM nullable
  UNION ALL SELECT 'nationkey', 'int', count(nationkey), count(*) FROM nullable""")
def table_info(t: Tables):
    return clean.table_info(nullable(t))


@query("head_rows", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5")
def head_rows(t: Tables):
    return clean.head_rows(t.customer.select("c_custkey", "c_name"), "c_custkey", 5)


@query("impute_median", with_(NULLABLE) + """SELECT c_custkey,
  round(coalesce(acctbal, (SELECT median(acctbal) FROM nullable)), 6) AS acctbal FROM nullable""")
def impute_median(t: Tables):
    filled = clean.impute_median(nullable(t), "acctbal")
    return filled.select("c_custkey", F.round("acctbal", 6).alias("acctbal"))


_MODE = "(SELECT segment FROM nullable WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)"


@query("impute_mode", with_(NULLABLE) + f"SELECT c_custkey, coalesce(segment, {_MODE}) AS segment FROM nullable")
def impute_mode(t: Tables):
    return clean.impute_mode(nullable(t), "segment").select("c_custkey", "segment")


@query("map_categories", """SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'MACHINERY' THEN 1
  WHEN 'FURNITURE' THEN 2 END AS segment FROM customer""")
def map_categories(t: Tables):
    codes = {"HOUSEHOLD": 0, "MACHINERY": 1, "FURNITURE": 2}
    return t.customer.select("c_custkey", clean.map_categories(F.col("c_mktsegment"), codes).alias("segment"))


_DICT = """dict AS (SELECT event_type, CAST(row_number() OVER (ORDER BY min(event_id)) - 1 AS INTEGER) AS label_index
  FROM events GROUP BY event_type)"""


@query("label_index", with_(_DICT) + "SELECT event_id, event_type, label_index FROM events JOIN dict USING (event_type)")
def label_index(t: Tables):
    indexed, _ = clean.label_index(t.events, "event_type", "event_id")
    return indexed.select("event_id", "event_type", "label_index")


@query("label_decode", with_(_DICT) + """SELECT event_id, e.label_index, event_type FROM
  (SELECT event_id, CAST(user_id % 7 AS INTEGER) AS label_index FROM events) e LEFT JOIN dict USING (label_index)""")
def label_decode(t: Tables):
    dictionary = clean.label_dictionary(t.events, "event_type", "event_id")
    coded = t.events.select("event_id", (F.col("user_id") % 7).cast("int").alias("label_index"))
    return clean.label_decode(coded, dictionary, F.col("event_id"))


@query("label_map_check", with_(_DICT, "seen AS (SELECT DISTINCT label_index, event_type FROM events LEFT JOIN dict USING (event_type))") + """
  SELECT count(DISTINCT label_index) AS labels, count(DISTINCT label_index) = count(*) AND count(DISTINCT event_type) = count(*) AS one_to_one FROM seen""")
def label_map_check(t: Tables):
    indexed, _ = clean.label_index(t.events, "event_type", "event_id")
    return clean.label_map_check(indexed, "label_index", "event_type")


@query("submission_shape", with_(PRED3) + "SELECT vec_id, prediction AS answer FROM embeddings LEFT JOIN p0 USING (vec_id)")
def submission_shape(t: Tables):
    return clean.submission(t.embeddings, pred3(t)["p0"], "vec_id", "prediction", "answer")


_K = r"TRY_CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)"
_RATIO = f"CASE WHEN {_K} % 10 <> 0 THEN value / ({_K} % 10) END"


def _ratio(t: Tables):
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("int")
    return t.events.select("event_id", "value", F.try_divide("value", k % 10).alias("ratio"))


@query("on_error_keep", f"SELECT event_id, round(coalesce({_RATIO}, value), 6) AS value FROM events")
def on_error_keep(t: Tables):
    kept = clean.on_error_keep(F.col("ratio"), F.col("value"))
    return _ratio(t).select("event_id", F.round(kept, 6).alias("value"))


@query("on_error_drop", f"SELECT event_id, round({_RATIO}, 6) AS value FROM events WHERE ({_RATIO}) IS NOT NULL")
def on_error_drop(t: Tables):
    return clean.on_error_drop(_ratio(t), "ratio").select("event_id", F.round("ratio", 6).alias("value"))


@query("join_align", with_(PRED3) + """SELECT vec_id, p0.prediction AS p0, p1.prediction AS p1, p2.prediction AS p2
  FROM p0 JOIN p1 USING (vec_id) JOIN p2 USING (vec_id)""")
def join_align(t: Tables):
    return joins.align(pred3(t), "vec_id", "prediction")


@query("anti_join", """SELECT doc_id, lang FROM documents d WHERE NOT EXISTS
  (SELECT 1 FROM documents o WHERE o.source = 'src0' AND o.text = d.text)""")
def anti_join(t: Tables):
    seen = t.documents.filter("source = 'src0'")
    return joins.not_in(t.documents, seen, "text", "doc_id").select("doc_id", "lang")


@query("lookup_join", """SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_join(t: Tables):
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    named = joins.lookup_join(t.customer, nations, "c_nationkey", salt_by=F.col("c_custkey"))
    return named.select("c_custkey", "n_name")


@query("key_match_count", """SELECT CAST(count_if(split_part(url, '.html', 1) = split_part(url, '#top', 1)) AS BIGINT) AS matches FROM pages""")
def key_match_count(t: Tables):
    return joins.key_match_count(t.pages, t.pages, "page_id", "url", ".html", "url", "#top")


@query("mapping_join", """SELECT doc_id, source, quality, toxic FROM labels JOIN documents USING (doc_id)""")
def mapping_join(t: Tables):
    name = F.concat(F.lit("doc"), "doc_id", F.lit(".txt"))
    files = t.documents.select(F.concat(F.lit("/data/"), name).alias("path"), "source")
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1))
    joined = t.labels.withColumn("file", name).join(named, "file")
    return joined.select("doc_id", "source", "quality", "toxic")


@query("agreement_counts", with_(PRED3) + """SELECT CAST(count_if(a = b AND a = c) AS BIGINT) AS agree,
  CAST(count_if(NOT (a = b AND a = c)) AS BIGINT) AS differ
  FROM (SELECT p0.prediction AS a, p1.prediction AS b, p2.prediction AS c
  FROM p0 JOIN p1 USING (vec_id) JOIN p2 USING (vec_id))""")
def agreement_counts(t: Tables):
    return evaluate.agreement_counts(joins.align(pred3(t), "vec_id", "prediction"), ["p0", "p1", "p2"])


@query("majority_vote", with_(PRED3) + """SELECT vec_id, CASE WHEN b = c THEN b ELSE a END AS prediction
  FROM (SELECT vec_id, p0.prediction AS a, p1.prediction AS b, p2.prediction AS c
  FROM p0 JOIN p1 USING (vec_id) JOIN p2 USING (vec_id))""")
def majority_vote(t: Tables):
    aligned = joins.align(pred3(t), "vec_id", "prediction")
    return aligned.select("vec_id", evaluate.majority_vote(["p0", "p1", "p2"]).alias("prediction"))
