"""Text functions and augmentation jobs (2.8), language counts (2.5)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import PAIRS, pairs
from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.functions import text as X
from tabprep.functions.seeded import u
from tabprep.operators import augment, profile
from tabprep.session import cut

SEED = 42
_WS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> '')"


def synonyms(t: Tables):
    """The 200 most frequent words, each with the next word and the next two joined by ``_``."""
    top = cut(augment.top_words(t.spread("documents", "doc_id"), ["text"], 202))
    shifted = {d: top.select(F.col("word").alias(f"w{d}"), (F.col("rank") - d).alias("rank")) for d in (1, 2)}
    joined = top.join(shifted[1], "rank").join(shifted[2], "rank")
    return joined.select("word", F.array("w1", F.concat_ws("_", "w1", "w2")).alias("synonyms"))


SYNONYMS = f"""wc AS (SELECT w, count(*) AS c FROM (SELECT unnest({_WS.format('text')}) AS w FROM documents) GROUP BY w),
rk AS (SELECT w, row_number() OVER (ORDER BY c DESC, w) AS r FROM wc QUALIFY r <= 202),
syn AS (SELECT a.w AS word, [b.w, concat(b.w, '_', c.w)] AS synonyms FROM rk a JOIN rk b ON b.r = a.r + 1
  JOIN rk c ON c.r = a.r + 2)"""


def _rewrites(t: Tables):
    """English texts of documents and conversations with their words in reverse order."""
    english = t.documents.filter("lang = 'en'").select("text").unionByName(t.conversations.select("text"))
    reverse = F.array_join(F.reverse(X.words(F.col("text"))), " ")
    return english.distinct().select(F.md5("text").alias("text_md5"), reverse.alias("rewritten"))


def rewrites(t: Tables):
    """The rewrites for more than one read."""
    return cut(_rewrites(t))


REWRITES = f"""rw AS (SELECT md5(text) AS text_md5, array_to_string(list_reverse({_WS.format('text')}), ' ') AS rewritten
  FROM (SELECT text FROM documents WHERE lang = 'en' UNION SELECT text FROM conversations))"""


def draw(salt: str, *parts: str, key: str = "id") -> str:
    return u_sql(SEED, key, f"'{salt}'", *parts)


def _chosen(ws: str, salt: str, key: str) -> str:
    return f"""{ws}[1 + CAST(floor({draw(salt, "'word'", key=key)} * len({ws})) AS BIGINT)]"""


def _syn_pick(salt: str, key: str) -> str:
    return f"""synonyms[1 + CAST(floor({draw(salt, "'synonym'", key=key)} * len(synonyms)) AS BIGINT)]"""


def replace_one_sql(src: str, key: str, text: str, salt: str, every: bool = False) -> str:
    """SELECT key, new text FROM src."""
    first = f"concat(substr({text}, 1, strpos({text}, w) - 1), s, substr({text}, strpos({text}, w) + length(w)))"
    new = f"replace({text}, w, s)" if every else first
    return f"""SELECT {key}, CASE WHEN s IS NULL THEN {text} ELSE {new} END AS {text} FROM (
      SELECT {key}, {text}, w, {_syn_pick(salt, key)} AS s FROM (
        SELECT {key}, {text}, {_chosen('ws', salt, key)} AS w FROM (
          SELECT {key}, {text}, {_WS.format(text)} AS ws FROM {src})) LEFT JOIN syn ON word = w)"""


def replace_each_sql(src: str, key: str, text: str, salt: str, p: float, out: str) -> str:
    return f"""SELECT {key}, coalesce(string_agg(CASE WHEN {draw(salt, "'word'", 'i', key=key)} < {p} AND len(o) > 0
        THEN replace(o[1 + CAST(floor({draw(salt, "'synonym'", 'i', key=key)} * len(o)) AS BIGINT)], '_', ' ')
        ELSE w END, ' ' ORDER BY i), '') AS {out} FROM (
      SELECT {key}, w, i, list_filter(synonyms, lambda s: lower(s) <> lower(w)) AS o FROM (
        SELECT {key}, unnest({_WS.format(text)}) AS w, generate_subscripts({_WS.format(text)}, 1) - 1 AS i FROM {src})
      LEFT JOIN syn ON word = w) GROUP BY {key}"""


def delete_sql(src: str, key: str, text: str, salt: str, min_words: int = 5) -> str:
    return f"""SELECT s.{key}, CASE WHEN len({_WS.format('s.' + text)}) < {min_words} THEN s.{text} ELSE coalesce(k.kept, '') END AS {text}
      FROM {src} s LEFT JOIN (SELECT {key}, string_agg(w, ' ' ORDER BY i) AS kept FROM (
        SELECT {key}, unnest({_WS.format(text)}) AS w, generate_subscripts({_WS.format(text)}, 1) - 1 AS i FROM {src})
        WHERE {draw(salt, 'i', key=key)} > 0.1 GROUP BY {key}) k ON k.{key} = s.{key}"""


def insert_sql(src: str, key: str, text: str, salt: str) -> str:
    place = f"""CAST(floor({draw(salt, "'place'", key=key)} * (len(ws) + 1)) AS BIGINT)"""
    return f"""SELECT {key}, CASE WHEN len(ws) < 5 THEN {text} WHEN s IS NULL THEN array_to_string(ws, ' ')
        ELSE array_to_string(list_concat(ws[1:{place}], [s], ws[{place} + 1:]), ' ') END AS {text} FROM (
      SELECT {key}, {text}, ws, {_syn_pick(salt, key)} AS s FROM (
        SELECT {key}, {text}, ws, {_chosen('ws', salt, key)} AS w FROM (
          SELECT {key}, {text}, {_WS.format(text)} AS ws FROM {src})) LEFT JOIN syn ON word = w)"""


def swap_sql(src: str, key: str, text: str, salt: str, p: float = 0.1) -> str:
    a = f"""CAST(floor({draw(salt, "'a'", key=key)} * len(ws)) AS BIGINT)"""
    b = f"""CAST(floor({draw(salt, "'b'", key=key)} * (len(ws) - 1)) AS BIGINT)"""
    return f"""SELECT {key}, CASE WHEN len(ws) < 2 THEN {text} WHEN {draw(salt, "'gate'", key=key)} < {p}
        THEN array_to_string(list_transform(range(len(ws)), lambda i: CASE i WHEN a THEN ws[b + 1] WHEN b THEN ws[a + 1] ELSE ws[i + 1] END), ' ')
        ELSE array_to_string(ws, ' ') END AS {text} FROM (
      SELECT {key}, {text}, ws, a, CASE WHEN b0 >= a THEN b0 + 1 ELSE b0 END AS b FROM (
        SELECT {key}, {text}, ws, {a} AS a, {b} AS b0 FROM (SELECT {key}, {text}, {_WS.format(text)} AS ws FROM {src})))"""


def _edit(t: Tables, f):
    return t.spread("documents", "doc_id").select("doc_id", f(F.col("text"), F.col("doc_id")).alias("text"))


def _edit_drawn(t: Tables, salt: str, f):
    docs = augment.with_drawn(t.spread("documents", "doc_id").select("doc_id", "text"), synonyms(t), "doc_id", "text", SEED, salt)
    return docs.select("doc_id", f(F.col("text"), F.col("doc_id"), F.col("_word"), F.col("_synonyms")).alias("text"))


@query("word_count", f"SELECT doc_id, CAST(len({_WS.format('text')}) AS INTEGER) AS words FROM documents")
def word_count(t: Tables):
    return t.spread("documents", "doc_id").select("doc_id", X.word_count(F.col("text")).alias("words"))


# --- language -------------------------------------------------------------------------------

_LETTERS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}]+'), lambda w: w <> '')"
PROFILE = f"""mw AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest({_LETTERS.format('text')}) AS w FROM documents) GROUP BY ALL),
mg AS (SELECT lang, gram, sum(n) AS n FROM (SELECT lang, n, unnest(list_transform(range(1, length(w) + 1),
  lambda i: substr(concat(' ', w, ' '), i, 3))) AS gram FROM mw) GROUP BY ALL),
ml AS (SELECT lang, sum(n) + (SELECT count(DISTINCT gram) FROM mg) AS room FROM mg GROUP BY ALL),
model AS (SELECT ml.lang, g.gram, ln((coalesce(mg.n, 0) + 1) / room) AS lp FROM ml CROSS JOIN (SELECT DISTINCT gram FROM mg) g
  LEFT JOIN mg ON mg.lang = ml.lang AND mg.gram = g.gram)"""


def detect_sql(src: str, key: str, text: str, out: str) -> str:
    """CTE ``out(key, language)``; every gram of the texts must be in the model or is unseen everywhere."""
    return f"""{out}_g AS (SELECT {key}, gram, count(*) AS n FROM (SELECT {key}, unnest(list_transform(range(1, length(w) + 1),
      lambda i: substr(concat(' ', w, ' '), i, 3))) AS gram FROM
      (SELECT {key}, unnest({_LETTERS.format(text)}) AS w FROM {src})) GROUP BY ALL),
    {out}_s AS (SELECT {key}, lang, sum(n * coalesce(lp, ln(1 / room))) AS s FROM {out}_g CROSS JOIN ml
      LEFT JOIN model USING (gram, lang) GROUP BY ALL),
    {out}_b AS (SELECT {key}, lang FROM {out}_s QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY s DESC, lang) = 1),
    {out} AS (SELECT {key}, coalesce({out}_b.lang, 'unknown') AS language FROM {src} LEFT JOIN {out}_b USING ({key}))"""


def _profile(t: Tables):
    return augment.language_profile(t.spread("documents", "doc_id"), "text", "lang")


@query("detect_language", with_(PROFILE, detect_sql("documents", "doc_id", "text", "det")) + "SELECT * FROM det")
def detect_language(t: Tables):
    return augment.detect_language(t.spread("documents", "doc_id"), "doc_id", "text", _profile(t))


@query("language_counts", with_(PROFILE, detect_sql("documents", "doc_id", "text", "det")) + """
  SELECT language, count(*) AS n, language = 'unknown' AS failed FROM det GROUP BY ALL""")
def language_counts(t: Tables):
    return profile.language_counts(detect_language(t), "language")


_BOTH = with_(PAIRS, PROFILE, detect_sql("pairs", "id", "premise", "dp"), detect_sql("pairs", "id", "hypothesis", "dh"),
              "gate AS (SELECT id FROM dp JOIN dh USING (id) WHERE dp.language = 'en' AND dh.language = 'en')")


def _with_english(t: Tables, df):
    """The pairs with ``english``: both sides are."""
    sides = [F.struct(F.col("id"), F.lit(s).alias("side"), F.col(s).alias("text")) for s in ("premise", "hypothesis")]
    long = df.select(F.inline(F.array(*sides))).withColumn("part", F.struct("id", "side"))
    found = augment.detect_language(long, "part", "text", _profile(t))
    both = found.groupBy("part.id").agg(F.bool_and(F.col("language") == "en").alias("english"))
    return df.join(both, "id")


@query("english_gate", _BOTH + "SELECT id, label FROM pairs JOIN gate USING (id)")
def english_gate(t: Tables):
    return _with_english(t, pairs(t)).filter("english").select("id", "label")


# --- edits ----------------------------------------------------------------------------------


@query("synonym_replace_one", with_(SYNONYMS) + replace_one_sql("documents", "doc_id", "text", "one"))
def synonym_replace_one(t: Tables):
    return _edit_drawn(t, "one", lambda c, k, w, s: X.replace_one(c, k, w, s, SEED, "one"))


@query("synonym_replace_all", with_(SYNONYMS) + replace_one_sql("documents", "doc_id", "text", "all", every=True))
def synonym_replace_all(t: Tables):
    return _edit_drawn(t, "all", lambda c, k, w, s: X.replace_one(c, k, w, s, SEED, "all", every=True))


@query("synonym_replace_each", with_(SYNONYMS, "each AS (" + replace_each_sql("documents", "doc_id", "text", "each", 0.18, "new") + ")")
       + "SELECT doc_id, coalesce(new, '') AS text FROM documents LEFT JOIN each USING (doc_id)")
def synonym_replace_each(t: Tables):
    docs = t.spread("documents", "doc_id").select("doc_id", "text")
    return augment.replace_each(docs, synonyms(t), "doc_id", [("text", "text", "each", 0.18)], SEED)


@query("synonym_rows", with_(SYNONYMS, "en AS (SELECT * FROM documents WHERE lang = 'en')",
                             "each AS (" + replace_each_sql("en", "doc_id", "text", "rows", 0.3, "new") + ")") + """
  SELECT doc_id, text, source FROM documents
  UNION ALL SELECT doc_id, coalesce(new, '') AS text, source FROM en LEFT JOIN each USING (doc_id)""")
def synonym_rows(t: Tables):
    docs = t.spread("documents", "doc_id").select("doc_id", "text", "lang", "source")
    return augment.synonym_rows(docs, synonyms(t), "doc_id", "text", F.col("lang") == "en", ["lang"], SEED)


@query("random_delete", delete_sql("documents", "doc_id", "text", "delete"))
def random_delete(t: Tables):
    return _edit(t, lambda c, k: X.delete_words(c, k, SEED, "delete"))


@query("random_delete_short", delete_sql("documents", "doc_id", "text", "short", min_words=2))
def random_delete_short(t: Tables):
    return _edit(t, lambda c, k: X.delete_words(c, k, SEED, "short", min_words=2))


@query("random_insert", with_(SYNONYMS) + insert_sql("documents", "doc_id", "text", "insert"))
def random_insert(t: Tables):
    return _edit_drawn(t, "insert", lambda c, k, w, s: X.insert_synonym(c, k, s, SEED, "insert"))


@query("random_swap", swap_sql("documents", "doc_id", "text", "swap"))
def random_swap(t: Tables):
    return _edit(t, lambda c, k: X.swap_words(c, k, SEED, "swap"))


@query("rewrite_lookup", with_(REWRITES) + f"""SELECT doc_id, CASE WHEN lang = 'en' AND {draw("rewrite", key="doc_id")} < 0.7
  THEN coalesce(rewritten, text) ELSE text END AS text FROM documents LEFT JOIN rw ON text_md5 = md5(text)""")
def rewrite_lookup(t: Tables):
    gate = (F.col("lang") == "en") & (u(SEED, F.col("doc_id"), "rewrite") < augment.REWRITE)
    return augment.rewrite_lookup(t.spread("documents", "doc_id"), rewrites(t), "doc_id", "text", gate).select("doc_id", "text")


def _step(no: int, name: str, chance: float, sql) -> str:
    """CTE s{no}: s{no-1} with one gated edit on both sides."""
    prev = f"s{no - 1}"
    sides = [f"SELECT id, {s} AS n FROM ({sql(prev, 'id', s, f'{name}-{s}')})" for s in ("premise", "hypothesis")]
    return f"""s{no} AS (SELECT p.id, CASE WHEN {u_sql(SEED, 'p.id', f"'{name}'")} < {chance} THEN a.n ELSE p.premise END AS premise,
      CASE WHEN {u_sql(SEED, 'p.id', f"'{name}'")} < {chance} THEN b.n ELSE p.hypothesis END AS hypothesis, p.label
      FROM {prev} p JOIN ({sides[0]}) a ON a.id = p.id JOIN ({sides[1]}) b ON b.id = p.id)"""


_S0 = f"""s0 AS (SELECT id, CASE WHEN g THEN coalesce(a.rewritten, premise) ELSE premise END AS premise,
  CASE WHEN g THEN coalesce(b.rewritten, hypothesis) ELSE hypothesis END AS hypothesis, label
  FROM (SELECT *, id IN (SELECT id FROM gate) AND {draw("rewrite")} < 0.7 AS g FROM pairs)
  LEFT JOIN rw a ON a.text_md5 = md5(premise) LEFT JOIN rw b ON b.text_md5 = md5(hypothesis))"""


@query("augment_pairs", _BOTH + "," + ",\n".join([
    SYNONYMS, REWRITES, _S0, _step(1, "synonym", 0.5, replace_one_sql), _step(2, "delete", 0.2, delete_sql),
    _step(3, "insert", 0.2, insert_sql), _step(4, "swap", 0.15, swap_sql)])
    + " SELECT id, premise, hypothesis, label FROM s4")
def augment_pairs(t: Tables):
    df = _with_english(t, pairs(t))
    out = augment.augment_pairs(df, cut(synonyms(t)), _rewrites(t), F.col("english"), SEED)
    return out.select("id", "premise", "hypothesis", "label")


_SIDES = {"premise": "premise", "hypothesis": "hypo"}


def _views(t: Tables):
    return augment.tta_wide(pairs(t), synonyms(t), "id", _SIDES, 5, SEED)


_VIEW_CTES = ",\n".join(
    f"{p}{v} AS (" + replace_each_sql("pairs", "id", c, f"{p}{v}", 0.18, "n") + ")" for v in range(1, 5) for c, p in _SIDES.items()
)
_VIEW_COLS = ", ".join(f"{c} AS {p}_tta0" for c, p in _SIDES.items()) + ", " + ", ".join(
    f"coalesce({p}{v}.n, '') AS {p}_tta{v}" for v in range(1, 5) for p in _SIDES.values()
)
_VIEW_JOINS = " ".join(f"LEFT JOIN {p}{v} ON {p}{v}.id = pairs.id" for v in range(1, 5) for p in _SIDES.values())


@query("tta_views", with_(PAIRS, SYNONYMS, _VIEW_CTES) + f"SELECT pairs.id, {_VIEW_COLS} FROM pairs {_VIEW_JOINS}")
def tta_views(t: Tables):
    return _views(t)


@query("tta_views_long", with_(PAIRS, SYNONYMS, _VIEW_CTES, f"wide AS (SELECT pairs.id, {_VIEW_COLS} FROM pairs {_VIEW_JOINS})")
       + " UNION ALL ".join(f"SELECT id, {v} AS view, premise_tta{v} AS premise, hypo_tta{v} AS hypo FROM wide" for v in range(5)))
def tta_views_long(t: Tables):
    return augment.tta_long(_views(t), "id", list(_SIDES.values()), 5)


_L, _VOCAB = 128, 5000
_ROOM = _L - 4


@query("encode_pair", with_(PAIRS, f"""
vc AS (SELECT w, count(*) AS c FROM (SELECT unnest({_WS.format('premise')}) AS w FROM pairs
  UNION ALL SELECT unnest({_WS.format('hypothesis')}) FROM pairs) GROUP BY w),
vocab AS (SELECT w, row_number() OVER (ORDER BY c DESC, w) + 3 AS code FROM vc QUALIFY code <= {_VOCAB} + 3),
tok AS (SELECT id, {_WS.format('premise')} AS a, {_WS.format('hypothesis')} AS b FROM pairs),
kept AS (SELECT id, a[1:least(len(a), greatest({_ROOM} - len(b), {_ROOM - _ROOM // 2}))] AS a,
  b[1:least(len(b), greatest({_ROOM} - len(a), {_ROOM // 2}))] AS b FROM tok),
laid AS (SELECT id, list_concat(['<s>'], a, ['</s>', '</s>'], b, ['</s>']) AS l, len(a) AS na FROM kept),
pos AS (SELECT id, unnest(l) AS w, generate_subscripts(l, 1) AS i, len(l) AS n, na FROM laid),
coded AS (SELECT id, i, n, CASE WHEN i = 1 THEN 0 WHEN i IN (na + 2, na + 3, n) THEN 2 ELSE coalesce(code, 3) END AS code
  FROM pos LEFT JOIN vocab USING (w))""") + f"""
SELECT id, array_to_string(list_concat(list(code ORDER BY i), list_transform(range({_L} - any_value(n)), lambda x: 1)), ' ') AS input_ids,
  CAST(any_value(n) AS INTEGER) AS mask_ones, {_L} AS length FROM coded GROUP BY id""")
def encode_pair(t: Tables):
    df = pairs(t)
    vocabulary = augment.top_words(df, ["premise", "hypothesis"], _VOCAB)
    coded = augment.encode_pair(df, vocabulary, "id", "premise", "hypothesis", _L)
    ones = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return coded.select(
        "id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        ones.alias("mask_ones"),
        F.size("input_ids").alias("length"),
    )
