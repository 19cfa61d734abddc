"""The registered queries of the subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import byte_bpe

    vocabulary = byte_bpe.Vocabulary.of_file(byte_bpe.default_path())
    return byte_bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import sharding

    return sharding.assign(table(spark, sf_dir, "documents"), "doc_id", "text", 24)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import simhash

    found = simhash.groups(table(spark, sf_dir, "documents"), "doc_id", "text", length=3, bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import decontaminate

    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text", size=10
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES["op6_decontaminate"] = f"""
WITH item AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t FROM cut),
doc AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
gram AS (SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM win))),
occ AS (SELECT doc_id, p, n, item_id FROM gram JOIN win USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM occ GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is the owner; its part in one language is a repository."""
    from tabprep.llm import secrets

    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    found = secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text", repository, F.col("source"))
    base = F.filter("spans", lambda s: s["at"] < len(secrets.BASE))

    def listed(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    def count(name: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    def judged(verdict: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["verdict"] == verdict)).cast("long").alias(f"n_{verdict}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), judged("live"), judged("example"),
    )


def _secrets_sql() -> str:
    from tabprep.llm import secrets

    kinds = [*secrets.BASE, secrets.OPAQUE]
    cuts = []
    for i, k in enumerate(kinds):
        pattern = k.pattern.replace("'", "''")
        keeps = f"length(v) >= {k.least}"
        if k is secrets.OPAQUE:
            keeps += " AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"
        cuts.append(
            f"""SELECT doc_id, repository, owner, {i} AS k, '{k.name}' AS kind, e - length(w) AS b, e, v FROM (
  SELECT *, CAST(sum(length(g) + length(w)) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS e FROM (
    SELECT doc_id, repository, owner, unnest(range(1, len(ws) + 1)) AS n, unnest(ws) AS w, unnest(vs) AS v, unnest(list_slice(gs, 1, len(ws))) AS g FROM (
      SELECT doc_id, repository, owner, regexp_extract_all(text, '{pattern}', 0) AS ws, regexp_extract_all(text, '{pattern}', {k.group}) AS vs,
        string_split_regex(text, '{pattern}') AS gs FROM doc WHERE regexp_matches(text, '{pattern}')))) WHERE {keeps}"""
        )
    return f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repository FROM documents),
found AS ({' UNION ALL '.join(cuts)}),
held AS (SELECT v, count(DISTINCT owner) AS owners FROM found GROUP BY v),
span AS (SELECT f.*, h.owners FROM found f JOIN held h USING (v) WHERE k < 3 OR (h.owners = 1 AND NOT EXISTS (
  SELECT 1 FROM found x WHERE x.k < 3 AND x.doc_id = f.doc_id AND x.b < f.e AND x.e > f.b))),
per AS (SELECT doc_id, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
  string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) FILTER (k < 3) AS base, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) AS al,
  count(*) FILTER (owners = 1) AS live, count(*) FILTER (owners >= {secrets.EXAMPLE_OWNERS}) AS example FROM span GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(al, '') AS spans, coalesce(live, 0) AS n_live, coalesce(example, 0) AS n_example
FROM doc LEFT JOIN per USING (doc_id)
"""


ORACLES["op8_secrets"] = _secrets_sql()


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import warc

    index = warc.write_archives(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return warc.resolve(warc.read_archives(index)).select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )


ORACLES["op3_warc"] = """
WITH page AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
told AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS least FROM page)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n < 100 OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM told
"""


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tabprep.llm import token_files

    docs = table(spark, sf_dir, "documents")
    tokenizer = token_files.Tokenizer.of_file(public_tokenizers.path("byte_bpe_50k.json"), end=0)
    manifest = token_files.write_files(docs, "doc_id", "text", tokenizer)
    return token_files.read_files(manifest, "doc_id", docs.schema["doc_id"].dataType.simpleString())


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample: one row per document that is kept."""
    from tabprep.llm import importance

    rows, _ = importance.resample(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "labels"))
    return rows.filter("kept").select("doc_id", "log_ratio", "score", "kept")


@query
def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import log_bilinear

    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return log_bilinear.score(table(spark, sf_dir, "documents"), "doc_id", "text", held_out)


@query
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import cross_polytope

    found = cross_polytope.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", cosine=0.9)
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


ORACLES["op4_cross_polytope"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM v JOIN least ON vec_id = least.a LEFT JOIN n ON vec_id = n.a
"""


@query
def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import pivot_clusters

    found, _ = pivot_clusters.cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", width=64, scale=64, k=16, rounds=3, seed=1)
    return found


def _clusters_sql() -> str:
    def dealt(round: int) -> str:
        """Nearest centroid of every vector; all numbers are whole, and far below 2**53 on the test tables."""
        return f"""a{round} AS (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'k': k}}) AS m FROM (
  SELECT v.*, c.k, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS d FROM v, c{round} c) GROUP BY rid)"""

    def moved(round: int) -> str:
        return f"""s{round} AS (SELECT k, list(f ORDER BY i) AS x FROM (SELECT m.k AS k, i, floor(sum(x[i]) / count(*)) AS f FROM a{round}, range(1, 65) r(i) GROUP BY m.k, i) GROUP BY k),
c{round + 1} AS (SELECT c.k, coalesce(s.x, c.x) AS x FROM c{round} c LEFT JOIN s{round} s USING (k))"""

    rounds = ",\n".join(f"{dealt(r)},\n{moved(r)}" for r in range(3))
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT 16)),
{rounds},
{dealt(3)},
mark AS (SELECT k, sha256(array_to_string(list_transform(x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS h FROM c3)
SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a3 JOIN mark ON mark.k = a3.m.k
"""


ORACLES["op11_pivot_clusters"] = _clusters_sql()


@query
def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import piece_bpe

    pieces = piece_bpe.Pieces.of_file(piece_bpe.default_path())
    return piece_bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text", pieces, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond the range of a long is null."""
    from tabprep.llm import whitening

    found, _ = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=4, scale=256)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))
