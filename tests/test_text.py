"""Words, edits, language, encoding."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabprep.functions import text as X
from tabprep.operators import augment

SAMPLES = ["", " ", "one", "two words", "a b c\n d\x1ce\x85f", "the cat sat on the mat by the door", "x" * 50 + " y z w v u"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "k INT, text STRING")


@pytest.fixture(scope="module")
def synonyms(spark):
    rows = [("the", ["a_b", "THE"]), ("cat", ["feline"]), ("mat", ["rug", "floor_mat"]), ("w", ["omega"]), ("none", [])]
    return spark.createDataFrame(rows, "word STRING, synonyms ARRAY<STRING>")


def test_words_split_like_python(docs):
    for r in docs.select("text", X.words(F.col("text")).alias("w"), X.word_count(F.col("text")).alias("n")).collect():
        assert r.w == r.text.split() and r.n == len(r.text.split())
    assert docs.select(X.word_count(F.lit(None).cast("string"))).first()[0] is None


def each(df, synonyms, seed, salt, p, key="k", text="text"):
    return augment.replace_each(df, synonyms, key, [(text, "new", salt, p)], seed).select(key, "new")


def test_join_ways_agree(docs, synonyms, monkeypatch):
    def edits():
        one = augment.with_drawn(docs, synonyms, "k", "text", 3, "o").select("k", X.replace_one(F.col("text"), F.col("k"), F.col("_word"), F.col("_synonyms"), 3, "o"))
        put = augment.with_drawn(docs, synonyms, "k", "text", 3, "i").select("k", X.insert_synonym(F.col("text"), F.col("k"), F.col("_synonyms"), 3, "i"))
        return [sorted(map(tuple, df.collect())) for df in (one, put, each(docs, synonyms, 3, "e", 0.9))]

    small = edits()
    original = augment.lookup_join
    monkeypatch.setattr(augment, "lookup_join", lambda *a, **kw: original(*a, **kw, broadcast_rows=1))
    assert edits() == small


def test_replace_each_never_gives_the_word_itself(docs, synonyms):
    got = each(docs, synonyms, 3, "e", 1.1).filter("k = 5").first()[1]
    assert got.startswith("a b feline sat on a b ") and got.endswith(" by a b door")


def test_replace_each_keeps_every_other_word(spark, synonyms):
    texts = {1: "the", 2: "x the", 3: "the x", 4: "x", 5: "", 6: None, 7: "x the the y cat z", 8: "none the none"}
    df = spark.createDataFrame(list(texts.items()), "k INT, text STRING")
    got = {r.k: r.new for r in each(df, synonyms.filter("word != 'mat'"), 3, "e", 1.1).collect()}
    assert got == {1: "a b", 2: "x a b", 3: "a b x", 4: "x", 5: "", 6: None, 7: "x a b a b y feline z", 8: "none a b none"}


def test_replace_one_hits_the_first_substring(spark):
    df = spark.createDataFrame([(1, "other the")], "k INT, t STRING")
    words = spark.createDataFrame([("the", ["X"]), ("other", ["Y"])], "word STRING, synonyms ARRAY<STRING>")
    seen = set()
    for seed in range(12):
        d = augment.with_drawn(df, words, "k", "t", seed, "s")
        args = F.col("t"), F.col("k"), F.col("_word"), F.col("_synonyms"), seed, "s"
        seen.add(tuple(d.select(X.replace_one(*args), X.replace_one(*args, every=True)).first()))
    assert seen == {("oXr the", "oXr X"), ("Y the", "Y the")}


def test_short_texts_stay(docs):
    for r in docs.select("text", X.delete_words(F.col("text"), F.col("k"), 1, "d", p=1.0).alias("d")).collect():
        n = len(r.text.split())
        assert r.d == (r.text if n < 5 else "")


def test_swap_moves_exactly_two_words(docs):
    for r in docs.select("text", X.swap_words(F.col("text"), F.col("k"), 1, "s", p=1.1).alias("s")).collect():
        before, after = r.text.split(), r.s.split()
        assert sorted(before) == sorted(after)
        if len(before) >= 2 and len(set(before)) == len(before):
            assert sum(a != b for a, b in zip(before, after)) == 2


def test_insert_adds_one_synonym(docs, synonyms):
    lengths = set()
    for seed in range(10):
        d = augment.with_drawn(docs, synonyms, "k", "text", seed, "i").filter("k = 5")
        new = d.select(X.insert_synonym(F.col("text"), F.col("k"), F.col("_synonyms"), seed, "i")).first()[0].split()
        lengths.add(len(new))
    assert lengths == {9, 10}  # words without synonyms add nothing


def test_edits_do_not_depend_on_partitions(docs, synonyms):
    run = lambda df: sorted(each(df, synonyms, 3, "e", 0.5).collect())
    assert run(docs.coalesce(1)) == run(docs.repartition(8))


def test_rewrite_by_join_of_either_kind(spark, monkeypatch):
    from tabprep.operators import joins

    df = spark.createDataFrame([(i, "hot" if i < 40 else f"t{i}") for i in range(60)], "k INT, text STRING")
    table = spark.createDataFrame([("hot", "cold"), ("t50", "new")], "t STRING, rewritten STRING")
    rewrites = table.select(F.md5("t").alias("text_md5"), "rewritten")
    run = lambda: sorted(augment.rewrite_lookup(df, rewrites, "k", "text", F.col("k") != 0).select("k", "text").collect())
    small = run()
    original = joins.lookup_join
    monkeypatch.setattr(augment, "lookup_join", lambda *a, **kw: original(*a, **kw, broadcast_rows=1))
    assert run() == small
    assert small[0] == (0, "hot") and small[1] == (1, "cold") and small[50] == (50, "new") and small[51] == (51, "t51")


def test_language(spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("this is the house", "en"), ("der hund und die katze", "de"), ("das ist das haus", "de")],
        "text STRING, lang STRING",
    )
    model = augment.language_profile(train, "text", "lang")
    new = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, "123 !?"), (4, "")], "k INT, text STRING")
    got = {r.k: r.language for r in augment.detect_language(new, "k", "text", model).collect()}
    assert got == {1: "en", 2: "de", 3: "unknown", 4: "unknown"}


def test_language_does_not_depend_on_the_route_of_a_word(spark, monkeypatch):
    monkeypatch.setattr(augment, "HOT_WORDS", 2)
    r = random.Random(3)
    words = {"en": "the cat and dog this is house of".split(), "de": "der hund und die katze das ist haus".split()}
    lines = [(i, " ".join(r.choice(words["en" if r.random() < p else "de"]) for _ in range(r.randint(0, 9)))) for i, p in enumerate([0.1, 0.9, 0.5] * 30)]
    df = spark.createDataFrame([*lines, (None, "the dog"), (0, "das haus")], "k INT, text STRING")
    train = spark.createDataFrame([(" ".join(w), k) for k, w in words.items()], "text STRING, lang STRING")
    model = augment.language_profile(train, "text", "lang")
    small = sorted(map(repr, augment.detect_language(df, "k", "text", model).collect()))
    assert sorted(map(repr, augment.detect_language(df, "k", "text", model, broadcast_words=0).collect())) == small and len(small) == 92


@pytest.mark.parametrize("broadcast_rows", [1, 1000])
def test_both_sides_are_rewritten_in_one_join_of_used_rewrites(spark, monkeypatch, broadcast_rows):
    rows = [(1, "t1", "t2", True), (1, "t3", "t1", True), (2, "t1", None, True), (None, "new", "t4", True), (3, "t1", "t2", False), (4, "t5", "t5", None)]
    df = spark.createDataFrame(rows, "id INT, premise STRING, hypothesis STRING, english BOOLEAN")
    table = spark.createDataFrame([(f"t{i}", f"r{i}") for i in range(1000)] + [(None, None)], "t STRING, rewritten STRING")
    looked = []
    original = augment.lookup_join

    def spy(df, dim, *a, **kw):
        looked.append(dim.count())
        return original(df, dim, *a, **{**kw, "broadcast_rows": broadcast_rows})

    monkeypatch.setattr(augment, "lookup_join", spy)
    rewrites = table.select(F.md5("t").alias("text_md5"), "rewritten")
    got = augment.rewrite_sides(df, rewrites, ["premise", "hypothesis"], F.col("english"))
    assert got.columns == df.columns
    want = [(1, "r1", "r2", True), (1, "r3", "r1", True), (2, "r1", None, True), (None, "new", "r4", True), (3, "t1", "t2", False), (4, "t5", "t5", None)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert len(looked) == 1 and looked[0] < 100


def test_the_size_of_a_table_is_told_from_widths(spark):
    from tabprep.operators import joins

    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k INT, text STRING")
    assert joins.fits(df, 50) and not joins.fits(df, 49) and not joins.fits(df, 50, 5000) and joins.fits(df.filter("k < 0"), 0)


GRAM_TEXTS = ["the Cat", "", None, " 12 the-the\n", "ÄÖ\U00010400b dé", "x", "東京都 the", "!?"]


def grams_of(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return [f" {w} "[i : i + 3] for w in words for i in range(len(w))]


@pytest.mark.parametrize("cells", [0, 1 << 22])
def test_trigrams_as_python_counts_them(spark, monkeypatch, cells):
    from tabprep.operators import trigrams

    monkeypatch.setattr(trigrams, "CELLS", cells)
    monkeypatch.setattr(trigrams, "SLICE", 9)
    rows = [(i, t, [None, "a", "b"][i % 3]) for i, t in enumerate(GRAM_TEXTS * 2)]
    df = spark.createDataFrame(rows, "k INT, text STRING, g STRING").coalesce(1)
    want = Counter((g, gram) for _, t, g in rows for gram in grams_of(t))
    got = {(r.g, r.gram): r.n for r in trigrams.count_trigrams(df, "text", "g").collect()}
    assert got == want
    known = sorted({gram for _, gram in want})[::2]
    model = spark.createDataFrame([(g, float(i + 1), -1.0) for i, g in enumerate(known)], "gram STRING, p0 DOUBLE, p1 DOUBLE")
    sums = {r.k: (r.p0, r.p1) for r in trigrams.sum_trigrams(df, "k", "text", model, ["p0", "p1"], [0.5, 0.25]).collect()}
    score = {g: (i + 1.0, -1.0) for i, g in enumerate(known)}
    each = {k: [score.get(g, (0.5, 0.25)) for g in grams_of(t)] for k, t, _ in rows}
    assert sums == {k: tuple(map(sum, zip(*x))) for k, x in each.items() if x}


def test_language_of_a_small_model_moves_no_word(spark, monkeypatch):
    def moved(*_, **__):
        raise AssertionError("a word or trigram of a text is a row")

    monkeypatch.setattr(augment, "elements", moved)
    monkeypatch.setattr(augment, "lookup_join", moved)
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("x", None)], "text STRING, lang STRING")
    model = augment.language_profile(train, "text", "lang")
    new = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, None), (4, "der"), (4, "hund"), (None, "dog")], "k INT, text STRING")
    got = sorted((r.k or 0, r.language) for r in augment.detect_language(new, "k", "text", model).collect())
    assert got == [(0, "unknown"), (1, "en"), (2, "de"), (3, "unknown"), (4, "de"), (4, "de")]


@pytest.mark.parametrize("na,nb,ka,kb", [(2, 3, 2, 3), (20, 2, 4, 2), (2, 20, 2, 4), (20, 20, 3, 3)])
def test_encode_pair_truncates_the_longer_side(spark, na, nb, ka, kb):
    df = spark.createDataFrame([("i", " ".join(["a"] * na), " ".join(["b"] * nb))], "id STRING, p STRING, h STRING")
    vocab = spark.createDataFrame([("a", 1), ("c", 2)], "word STRING, rank INT")
    r = augment.encode_pair(df, vocab, "id", "p", "h", 10).first()
    real = [0] + [4] * ka + [2, 2] + [3] * kb + [2]
    assert r.input_ids == real + [1] * (10 - len(real))
    assert r.attention_mask == [1] * len(real) + [0] * (10 - len(real))


def test_a_draw_is_compared_by_its_digits(spark):
    """``below`` is ``u < p``, also at bounds that a draw meets, and needs no number made of the digits."""
    from tabprep.functions.seeded import below, u, u32

    rows = spark.range(300)
    met = rows.select(u32(1, F.col("id")).alias("n")).filter("id = 7").first()["n"] / 2**32
    for p in (0.0, 0.18, 0.3, met, 0.9999999, 1.0):
        found = rows.select((u(1, F.col("id")) < p).alias("a"), below(p, 1, F.col("id")).alias("b")).collect()
        assert all(r.a == r.b for r in found)
    plan = rows.select(X.is_drawn(F.col("id"), F.col("id"), 1, "s", 0.18))._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan
