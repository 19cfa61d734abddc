"""Text augmentation, language detection and pair encoding as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions import text as X
from tabprep.functions.arrays import elements
from tabprep.functions.seeded import u
from tabprep.operators.joins import BROADCAST_ROWS, KeyBitmap, fits, lookup_join
from tabprep.operators.trigrams import count_trigrams, sum_trigrams
from tabprep.session import cut

def with_drawn(
    df: DataFrame, dictionary: DataFrame, key: str, text: str, seed: int, salt: str, word: str = "_word", out: str = "_synonyms"
) -> DataFrame:
    """Add the word that an edit of ``text`` draws and its synonyms, by a join on that one word.

    ``dictionary`` is (word, synonyms), unique on ``word``.
    """
    drawn = df.withColumn(word, X.drawn_word(F.col(text), F.col(key), seed, salt))
    named = dictionary.select(F.col("word").alias(word), F.col("synonyms").alias(out))
    return lookup_join(drawn, named, word, "left", F.col(key))


def replace_each(
    df: DataFrame, dictionary: DataFrame, key: str, edits: Sequence[tuple[str, str, str, float]], seed: int
) -> DataFrame:
    """Columns in which each word of a text, with some chance, became one of its synonyms other than itself.

    ``edits`` are (text column, new column, salt, chance); all are looked up in one join, and
    only the words that were drawn. ``key`` is unique. A new column may replace its text.
    """
    def drawn_words(n: int, text: str, salt: str, p: float) -> Column:
        placed = F.transform(X.words(F.col(text)), lambda w, i: F.struct(F.lit(n).alias("edit"), i.alias("pos"), w.alias("word")))
        return F.filter(placed, lambda s: X.is_drawn(F.col(key), s["pos"], seed, salt, p))

    drawn = F.array(*[drawn_words(n, text, salt, p) for n, (text, _, salt, p) in enumerate(edits)])
    k = F.col(key)
    each = elements(df, [key], F.flatten(F.array_compact(drawn)), "_w").select(key, "_w.*")
    found = lookup_join(each, dictionary.select("word", "synonyms"), "word", "inner", F.struct(key, "edit", "pos"))
    new = F.lit(None).cast("string")
    for n, (_, _, salt, _) in enumerate(edits):
        new = F.when(F.col("edit") == n, X.other_synonym(F.col("word"), F.col("synonyms"), k, F.col("pos"), seed, salt)).otherwise(new)
    put = found.select(key, "edit", "pos", new.alias("new")).filter("new is not null")
    # the replaced words of one row
    rows = put.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("edit", "pos", F.col("new").alias("word")))).alias("_put"))
    joined = df.join(rows, key, "left")
    none = F.array().cast(rows.schema["_put"].dataType)
    own = lambda n: F.filter(F.coalesce("_put", none), lambda s: s["edit"] == n)
    return joined.withColumns({out: X.put_words(F.col(text), own(n)) for n, (text, out, _, _) in enumerate(edits)}).drop("_put")


def corpus_words(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """``(word, n)`` over one or more text columns."""
    tokens = F.flatten(F.array(*[F.coalesce(X.words(F.col(t)), F.array()) for t in texts]))
    return elements(df, [], tokens, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, texts: Sequence[str], size: int) -> DataFrame:
    """``(word, rank)``: the ``size`` most frequent words, ranked from 1; ties by the word."""
    order = [F.desc("n"), F.asc("word")]
    top = corpus_words(df, texts).orderBy(*order).limit(size)
    # at most `size` rows reach this window
    return top.select("word", F.row_number().over(Window.orderBy(*order)).alias("rank"))


def rewrite_lookup(
    df: DataFrame, rewrites: DataFrame, key: str, text: str, gate: Column, out: str | None = None
) -> DataFrame:
    """Rows that pass the gate take the stored rewrite of their text, if there is one.

    ``rewrites`` is unique on ``text_md5``. Repeated texts are one hot key; the join
    broadcasts a small table and salts the rows for a large one.
    """
    keyed = df.withColumn("text_md5", F.md5(text))
    joined = lookup_join(keyed, rewrites.select("text_md5", "rewritten"), "text_md5", "left", F.col(key))
    new = F.when(gate, F.coalesce("rewritten", F.col(text))).otherwise(F.col(text))
    return joined.withColumn(out or text, new).drop("text_md5", "rewritten")


def rewrite_sides(df: DataFrame, rewrites: DataFrame, sides: Sequence[str], gate: Column) -> DataFrame:
    """As ``rewrite_lookup`` of each side in turn, with one join for all of them.

    Only texts of rows that pass the gate are looked up, and only their rewrites move: a bitmap of their digests
    goes over ``rewrites``, which is read once. The rows are stored under a number of their own, so keys may repeat.
    """
    rows = cut(df.withColumns({"_row": F.monotonically_increasing_id(), "_gate": gate}))
    texts = F.array(*[F.struct(F.lit(n).alias("side"), F.md5(s).alias("text_md5")) for n, s in enumerate(sides)])
    each = rows.filter("_gate").select("_row", F.inline(texts)).filter("text_md5 is not null")
    known = KeyBitmap(cut(each.select("text_md5").distinct()), ["text_md5"])
    used = cut(known.split(rewrites.select("text_md5", "rewritten"), ["text_md5"], "left_semi"))
    found = lookup_join(each, used, "text_md5", "inner", F.struct("_row", "side"))
    new = found.groupBy("_row").agg(*[F.max(F.when(F.col("side") == n, F.col("rewritten"))).alias(f"_new{n}") for n in range(len(sides))])
    out = rows.join(new, "_row", "left").withColumns({s: F.coalesce(f"_new{n}", F.col(s)) for n, s in enumerate(sides)})
    return out.drop("_row", "_gate", *[f"_new{n}" for n in range(len(sides))])


# fixed value: chance of a word to be replaced in a view
VIEW_CHANCE = 0.18
# fixed values: chance of each step, in order
REWRITE, SYNONYM, DELETE, INSERT, SWAP = 0.7, 0.5, 0.2, 0.2, 0.15


def augment_pairs(
    df: DataFrame,
    synonyms: DataFrame,
    rewrites: DataFrame,
    english: Column,
    seed: int,
    key: str = "id",
    sides: Sequence[str] = ("premise", "hypothesis"),
) -> DataFrame:
    """Rewrite, synonym, delete, insert, swap: each step by one draw that both sides share.

    One row out per row in; key and label are kept. ``english`` must hold for the rewrite.
    """
    k = F.col(key)

    def gate(step: str, chance: float) -> Column:
        return u(seed, k, step) < chance

    out = rewrite_sides(df, rewrites, sides, english & gate("rewrite", REWRITE))
    word, found = F.col("_word"), F.col("_synonyms")
    steps = [
        ("synonym", SYNONYM, True, lambda c, salt: X.replace_one(c, k, word, found, seed, salt)),
        ("delete", DELETE, False, lambda c, salt: X.delete_words(c, k, seed, salt)),
        ("insert", INSERT, True, lambda c, salt: X.insert_synonym(c, k, found, seed, salt)),
        ("swap", SWAP, False, lambda c, salt: X.swap_words(c, k, seed, salt)),
    ]
    for name, chance, looks_up, edit in steps:
        for s in sides:
            if looks_up:
                out = with_drawn(out, synonyms, key, s, seed, f"{name}-{s}")
            out = out.withColumn(s, F.when(gate(name, chance), edit(F.col(s), f"{name}-{s}")).otherwise(F.col(s))).drop("_word", "_synonyms")
    return out


def synonym_rows(
    df: DataFrame, synonyms: DataFrame, key: str, text: str, english: Column, drop: Sequence[str], seed: int
) -> DataFrame:
    """The rows, plus for each English row a copy with synonyms in ``text``; language columns dropped."""
    copies = replace_each(df.filter(english), synonyms, key, [(text, text, "rows", 0.3)], seed)
    return df.unionByName(copies).drop(*drop)


def tta_wide(
    df: DataFrame, synonyms: DataFrame, key: str, sides: dict[str, str], views: int, seed: int
) -> DataFrame:
    """``(<side>_tta0 .. <side>_tta{views-1}, key)``: the text itself and seeded variants of it.

    ``sides`` maps a text column to its output prefix.
    """
    edits = [(c, f"{prefix}_tta{v}", f"{prefix}{v}", VIEW_CHANCE) for v in range(1, views) for c, prefix in sides.items()]
    out = replace_each(df.select(key, *sides), synonyms, key, edits, seed).withColumns({f"{p}_tta0": F.col(c) for c, p in sides.items()})
    return out.select(*[f"{p}_tta{v}" for v in range(views) for p in sides.values()], key)


def tta_long(wide: DataFrame, key: str, prefixes: Sequence[str], views: int) -> DataFrame:
    """``(key, view, <prefix>...)`` from the wide form."""
    rows = [
        F.struct(F.lit(v).alias("view"), *[F.col(f"{p}_tta{v}").alias(p) for p in prefixes]) for v in range(views)
    ]
    return wide.select(key, F.inline(F.array(*rows)))


#: Languages at most; words whose scores are broadcast when not all trigrams' are.
MOST_LANGUAGES, HOT_WORDS = 500, 1 << 16


def _trigrams(df: DataFrame, word: str) -> DataFrame:
    """One row per character trigram ``gram`` of each word with a blank on both sides."""
    at = df.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length(word))))
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return at.withColumn("gram", F.substr(padded, F.col("_at"), F.lit(3))).drop("_at")


def language_profile(df: DataFrame, text: str, lang: str) -> tuple[DataFrame, list[str], list[float]]:
    """Trigram log-probabilities per language with add-one smoothing.

    Returns ``(gram, p0..pk)``, the languages in order, and the log-probability of a trigram
    never seen in a language. Trigrams are counted where the texts are read; no word moves.
    """
    counted = cut(count_trigrams(df, text, lang))
    totals = counted.groupBy(lang).agg(F.sum("n").alias("n")).orderBy(lang).limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages, each of which is a column")
    grams = counted.agg(F.count_distinct("gram")).first()[0]
    langs = [r[0] for r in totals]
    room = [float(r["n"] + grams) for r in totals]

    def logp(i: int) -> Column:
        seen = F.coalesce(F.sum(F.when(F.col(lang) == langs[i], F.col("n"))), F.lit(0))
        return F.log((seen + 1) / F.lit(room[i])).alias(f"p{i}")

    model = cut(counted.groupBy("gram").agg(*[logp(i) for i in range(len(langs))]))
    unseen = df.sparkSession.range(1).select(*[F.log(1 / F.lit(r)) for r in room]).first()
    return model, langs, list(unseen)


def detect_language(
    df: DataFrame, key: str, text: str, profile: tuple[DataFrame, list[str], list[float]], broadcast_words: int = BROADCAST_ROWS
) -> DataFrame:
    """``(key, language)``: the language that makes the trigrams most likely; no letters: ``unknown``.

    The scores of up to ``broadcast_words`` trigrams are broadcast, and a text's are added up where it is read.
    Of more trigrams, a word's are looked up once, however often and wherever it stands; the scores of the ``HOT_WORDS``
    most frequent words are broadcast and the others joined, so that none that is joined holds more than one in
    ``HOT_WORDS`` of all.
    """
    model, langs, unseen = profile
    scores = [f"p{i}" for i in range(len(langs))]
    if fits(model, broadcast_words):
        told = sum_trigrams(df, key, text, model, scores, unseen)
    else:
        words = elements(df, [key], X.letter_words(F.col(text)), "word")
        counted = cut(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        scored = lookup_join(_trigrams(counted.select("word"), "word"), model, "gram", "left", F.struct("word", "gram"))
        of_word = cut(scored.groupBy("word").agg(*[F.sum(F.coalesce(p, F.lit(miss))).alias(p) for p, miss in zip(scores, unseen, strict=True)]))
        hot = of_word.join(F.broadcast(counted.orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word")), "word", "left_semi")
        others = words.join(F.broadcast(hot.select("word")), "word", "left_anti")
        told = words.join(F.broadcast(hot), "word").unionByName(others.join(of_word, "word"))
    sums = told.groupBy(key).agg(*[F.sum(p).alias(p) for p in scores])
    best = F.array_max(F.array(*[F.struct(F.col(p).alias("s"), F.lit(-i).alias("i")) for i, p in enumerate(scores)]))
    names = F.array(*[F.lit(x) for x in langs])
    found = sums.select(key, F.get(names, -best["i"]).alias("language"))
    return df.select(key).join(found, key, "left").fillna("unknown", ["language"])


# fixed values: ids of the special tokens of a pair encoding
START, PAD, END, UNKNOWN, FIRST_WORD = 0, 1, 2, 3, 4


def encode_pair(
    df: DataFrame, vocabulary: DataFrame, key: str, premise: str, hypothesis: str, length: int
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of fixed length.

    Layout: start, premise, end, end, hypothesis, end, padding. Too long a pair loses words
    of its longer side first, of the hypothesis when both are equal. ``vocabulary`` is
    ``(word, rank)``, bounded by the size it was built with.
    """
    room = length - 4
    split = df.withColumns({"_a": X.words(F.col(premise)), "_b": X.words(F.col(hypothesis))})
    a, b = F.size("_a"), F.size("_b")
    keep_a = F.least(a, F.greatest(room - b, F.lit(room - room // 2)))
    keep_b = F.least(b, F.greatest(room - a, F.lit(room // 2)))
    sides = {"_a": F.slice("_a", F.lit(1), keep_a), "_b": F.slice("_b", F.lit(1), keep_b)}
    kept = split.withColumns(sides)

    def placed(n: int, side: str) -> Column:
        return F.transform(side, lambda w, i: F.struct(F.lit(n).alias("side"), i.alias("pos"), w.alias("word")))

    # at most `room` words of a pair
    each = elements(kept, [key], F.concat(placed(0, "_a"), placed(1, "_b")), "_w").select(key, "_w.*")
    found = lookup_join(each, vocabulary.select("word", "rank"), "word", "left", F.struct(key, "side", "pos"))
    code = F.coalesce(F.col("rank") + (FIRST_WORD - 1), F.lit(UNKNOWN)).alias("id")
    codes = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("side", "pos", code))).alias("_c"))
    joined = kept.join(codes, key, "left")

    def ids(n: int) -> Column:
        none = F.array().cast(codes.schema["_c"].dataType)
        return F.transform(F.filter(F.coalesce("_c", none), lambda s: s["side"] == n), lambda s: s["id"])

    end = F.array(F.lit(END))
    coded = joined.withColumn("_ids", F.concat(F.array(F.lit(START)), ids(0), end, end, ids(1), end))
    n = F.size("_ids")
    return coded.withColumns(
        {
            "input_ids": F.concat("_ids", F.array_repeat(F.lit(PAD), length - n)),
            "attention_mask": F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), length - n)),
        }
    ).drop("_a", "_b", "_ids", "_c")
