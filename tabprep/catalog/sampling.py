"""Set operations, sampling, splitting (2.7)."""

from pyspark.sql import functions as F

from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.operators import sampling

_N = "(SELECT count(*) FROM documents)"


def _order(salt: str, key: str = "doc_id", seed: int = 42) -> str:
    return f"""row_number() OVER (ORDER BY {u_sql(seed, key, f"'{salt}'")}, {key})"""


def _docs(t: Tables):
    return t.documents.select("doc_id", "lang", "source")


@query("union_all", """SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) - 1 AS row FROM
  (SELECT doc_id, 0 AS k FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id, 1 FROM labels)""")
def union_all(t: Tables):
    french = t.documents.filter("lang = 'fr'").select("doc_id")
    return sampling.union_all([french, t.labels.select("doc_id")], "doc_id")


@query("distinct_values", "SELECT DISTINCT text FROM documents")
def distinct_values(t: Tables):
    return t.documents.select("text").distinct()


@query("split_fraction", f"SELECT doc_id, CASE WHEN {_order('split')} <= {_N} // 5 THEN 'dev' ELSE 'train' END AS part FROM documents")
def split_fraction(t: Tables):
    return sampling.split_fraction(t.documents.select("doc_id"), "doc_id", k=5, seed=42)


@query("split_fraction_tenth", f"SELECT doc_id, CASE WHEN {_order('split', seed=7)} <= {_N} // 10 THEN 'dev' ELSE 'train' END AS part FROM documents")
def split_fraction_tenth(t: Tables):
    return sampling.split_fraction(t.documents.select("doc_id"), "doc_id", k=10, seed=7)


@query("split_seeded", f"SELECT doc_id, CASE WHEN {_order('split')} <= ceil(0.2 * {_N}) THEN 'test' ELSE 'train' END AS part FROM documents")
def split_seeded(t: Tables):
    return sampling.split_seeded(t.documents.select("doc_id"), "doc_id")


@query("sample_n", f"SELECT doc_id, lang FROM documents QUALIFY {_order('sample')} <= 50")
def sample_n(t: Tables):
    return sampling.sample_n(_docs(t), "doc_id", 50, seed=42).select("doc_id", "lang")


@query("sample_n_per_class", f"""SELECT doc_id, source FROM documents QUALIFY row_number() OVER
  (PARTITION BY source ORDER BY {u_sql(42, 'doc_id', "'sample'")}, doc_id) <= 6""")
def sample_n_per_class(t: Tables):
    return sampling.sample_per_class(_docs(t), "doc_id", "source", 6, seed=42).select("doc_id", "source")


@query("mix_by_ratio", with_(f"""a AS (SELECT doc_id, 0 AS source_no, {_order('mix0')} AS r FROM documents WHERE lang = 'en'),
b AS (SELECT doc_id, 1 AS source_no, {_order('mix1')} AS r FROM documents WHERE lang <> 'en')""") + """
  SELECT doc_id, source_no FROM a WHERE r <= floor(0.8 * (SELECT count(*) FROM a))
  UNION ALL SELECT doc_id, source_no FROM b WHERE r <= floor(0.2 * (SELECT count(*) FROM a))""")
def mix_by_ratio(t: Tables):
    docs = _docs(t)
    sources = [(docs.filter("lang = 'en'"), 0.8), (docs.filter("lang <> 'en'"), 0.2)]
    return sampling.mix_by_ratio(sources, "doc_id", seed=42).select("doc_id", "source_no")


@query("shuffle", f"SELECT doc_id, {_order('epoch3')} AS position FROM documents")
def shuffle(t: Tables):
    return sampling.shuffle(t.documents.select("doc_id"), "doc_id", seed=42, epoch=3)
