"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ten consecutive words; a document holds a window if the words
stand in it one after the other. Containment is exact, so of a window's word shingles any one
is a sufficient prefix, and the rarest in the corpus is taken. Document shingles meet only
these; where one does, its position in the window fixes where the window would begin, the
document's length bounds it, and its words are compared.

Texts are read as bytes in numpy. What a task carries is a bitmap of fixed size over the wanted shingles; it lets through some others,
which the joins drop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import numbered, slices, stored, text_of
from tabprep.llm.words import HASHED, LETTERS, Words

#: Words of a shingle.
SHINGLE = 3
#: Bits of the bitmap: 2 to this power at least and at most, 32 per wanted shingle between.
LEAST_BITS, MOST_BITS = 12, 24
def _windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``item, window, len, shingles``: the windows of every item; an item with fewer words is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, HASHED):
            words = Words(part.column(1), LETTERS)
            hashes = {s: words.shingles(s)[0] for s in range(1, SHINGLE + 1)}
            at, item, window, lens, parts = words.first.tolist(), [], [], [], []
            for i, name in enumerate(part.column(0).to_pylist()):
                n = at[i + 1] - at[i]
                long = min(size, n)
                short = min(SHINGLE, long)
                for a in range(at[i], at[i + 1] - long + 1 if n else 0):
                    item.append(name)
                    window.append(words.text(a, a + long))
                    lens.append(long)
                    parts.append(hashes[short][a : a + long - short + 1].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, part.column(0).type), pa.array(window, pa.string()), pa.array(lens, pa.int32()), pa.array(parts, pa.list_(pa.int64()))],
                names=["item", "window", "len", "shingles"],
            )

    kind = items.schema[key].dataType.simpleString()
    return items.select(F.col(key).alias("item"), text_of(text).alias("text")).mapInArrow(
        run, f"item {kind}, window string, len int, shingles array<bigint>"
    )


class Bitmap:
    """A set of hashes, with false members, in a fixed number of bits."""

    def __init__(self, hashes: DataFrame, column: str):
        n = hashes.count()
        self.bits = min(MOST_BITS, max(LEAST_BITS, (32 * n).bit_length()))
        place = F.shiftrightunsigned(F.col(column), 64 - self.bits)
        words = (
            hashes.select(F.shiftright(place, 5).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(31).cast("int")).alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b"))
        )
        self.words = np.zeros(1 << (self.bits - 5), np.uint32)
        for w, b in words.collect():  # at most 2**19 rows
            self.words[w] = b

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.bits)
        return (self.words[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def _counts(docs: DataFrame, wanted: Bitmap) -> DataFrame:
    """``shingle, n``: how often wanted shingles stand in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, HASHED):
            words = Words(part.column(0), LETTERS)
            found = []
            for size in range(1, SHINGLE + 1):
                hashes, whole = words.shingles(size)
                found.append(hashes[wanted.has(hashes) & whole])
            shingle, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    return docs.select("text").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))


def _hits(docs: DataFrame, prefixes: Bitmap, size: int) -> DataFrame:
    """``key, n_words, hits``: each document's wanted shingles with the words around them."""
    around = size - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, HASHED):
            words = Words(part.column(1), LETTERS)
            hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for short in range(1, SHINGLE + 1):
                hashes, whole = words.shingles(short)
                places = np.flatnonzero(prefixes.has(hashes) & whole)
                owners = np.searchsorted(words.first, places, side="right") - 1
                for p, d, h in zip(places.tolist(), owners.tolist(), hashes[places].view(np.int64).tolist(), strict=True):
                    begin, end = int(words.first[d]), int(words.first[d + 1])
                    a, b = max(begin, p - around), min(end, p + short + around)
                    hits[d].append({"shingle": h, "at": p - begin, "left": a - begin, "words": words.text(a, b)})
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(words.first).astype(np.int64)), pa.array(hits, HITS)], names=["key", "n_words", "hits"]
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n_words bigint, hits array<struct<shingle: bigint, at: int, left: int, words: string>>")


HITS = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("left", pa.int32()), ("words", pa.string())]))


def contamination(df: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, size: int = 10) -> DataFrame:
    """``key, n_words, n_hit, items``: how much of each whole document stands in the items.

    A word is a run of digits, letters a-z in either case, and all characters beyond ASCII.
    ``n_hit`` counts words inside any occurrence of a window of ``size`` words, ``items`` are
    the keys of the items that have such a window, as sorted strings.

    Null and empty texts have no words and no hits; items without words have no window; an
    item with a null key counts into ``n_hit`` but not into ``items``. Every row of ``df``
    gives one row, also where keys are null or repeat. Empty tables give an empty result or
    one without hits; other columns are not read.

    Two passes over the texts: one counts the items' shingles in the whole corpus, one finds
    the rarest of each window. What moves between tasks are counts and found places.
    """
    docs = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    windows = stored(_windows(items, item_key, item_text, size), "windows")
    distinct = windows.groupBy("window").agg(F.first("len").alias("len"), F.first("shingles").alias("shingles"))
    shingles = distinct.select("window", "len", F.posexplode("shingles").alias("offset", "shingle"))
    wanted = shingles.select("shingle").distinct()
    counts = _counts(docs, Bitmap(wanted, "shingle"))
    # a window whose shingles do not all occur cannot occur itself
    ranked = stored(
        shingles.join(counts, "shingle", "left").groupBy("window").agg(
            F.first("len").alias("len"), F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("least")
        ).filter("least.n > 0").select("window", "len", "least.shingle", "least.offset"),
        "prefixes",
    )
    rows = stored(_hits(docs, Bitmap(ranked.select("shingle").distinct(), "shingle"), size).withColumn("row", F.monotonically_increasing_id()), "hits")

    found = rows.select("row", "n_words", F.explode("hits").alias("hit")).select("row", "n_words", "hit.*")
    begin = F.col("at") - F.col("offset")
    inside = (begin >= 0) & (begin + F.col("len") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("words", " "), F.greatest(begin - F.col("left"), F.lit(0)) + 1, F.col("len")), " ") == F.col("window")
    matches = stored(found.join(ranked, "shingle").filter(inside & same).select("row", begin.alias("begin"), (begin + F.col("len")).alias("end"), "window"), "matches")

    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = matches.select("row", "begin", "end").distinct().select("row", F.greatest(F.col("end") - reached, F.lit(0)).alias("n"))
    hit = covered.groupBy("row").agg(F.sum("n").cast("long").alias("n_hit"))
    named = windows.filter("item is not null").select(F.col("item").cast("string").alias("item"), "window").distinct()
    of = matches.select("row", "window").distinct().join(named, "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return rows.select("row", "key", "n_words").join(hit, "row", "left").join(of, "row", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def clean(df: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, size: int = 10) -> DataFrame:
    """The rows of ``df`` that hold no window of an item, with all columns."""
    docs, row = numbered(df, "documents")
    found = contamination(docs, row, text, items, item_key, item_text, size).filter("n_hit > 0").select(row)
    return docs.join(found, row, "left_anti").select(*(F.col(f"`{c}`") for c in df.columns))
