"""Character trigrams of words, counted and scored in Arrow batches.

Texts come as words of letters between blanks. A letter and its neighbours, a word's border being
a blank, are one trigram; three numbers of letters make its code.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text a task works on at once; cells of a table by code, beyond which codes are sorted.
SLICE, CELLS = 2 << 20, 1 << 22
_BLANK, _CODE_POINTS = 32, 0x110000


def letters(text: Column) -> Column:
    """Lower-case words of letters with a blank for whatever is between, before or behind them."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def _slices(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Other column, text starts and code points of some rows; a blank stands before the first text, behind each and at the end."""
    for batch in batches:
        texts = [x or "" for x in batch.column(1).to_pylist()]
        first = size = 0
        for last, text in enumerate(texts, 1):
            size += len(text)
            if size >= most or last == len(texts):
                part = texts[first:last]
                starts = np.cumsum([1, *[len(x) + 1 for x in part]])
                points = np.frombuffer(f" {' '.join(part)}  ".encode("utf-32-le"), np.uint32)
                yield batch.column(0).slice(first, last - first), starts, points
                first, size = last, 0


def _codes(rank: np.ndarray, points: np.ndarray, size: int) -> np.ndarray:
    """The code of each place's trigram but for the first place and the last."""
    a = rank[points]
    return (a[:-2] * size + a[1:-1]) * size + a[2:]


def count_trigrams(df: DataFrame, text: str, group: str) -> DataFrame:
    """``(group, gram, n)``: how often each trigram stands in a group's texts. A task adds up its own first."""
    most, cells = SLICE, CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(_CODE_POINTS, np.int64)
        for column, starts, points in _slices(batches, most):
            there = np.zeros(_CODE_POINTS, bool)
            there[points] = True
            chars = np.flatnonzero(there).astype(np.uint32)
            size = len(chars)
            rank[chars] = np.arange(size)
            groups = column.dictionary_encode()
            none = len(groups.dictionary)
            of_row = groups.indices.fill_null(none).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = _codes(rank, points, size) + np.repeat(of_row * size**3, np.diff(starts))
            codes = codes[points[1:-1] != _BLANK]
            if (none + 1) * size**3 <= cells:
                n = np.bincount(codes)
                found = np.flatnonzero(n)
                n = n[found]
            else:
                found, n = np.unique(codes, return_counts=True)
            of_gram, found = np.divmod(found, size**3)
            three = np.stack([chars[found // size**2], chars[found // size % size], chars[found % size]], axis=1)
            grams = np.ascontiguousarray(three).view("<U3").ravel().tolist()
            out = [groups.dictionary.take(pa.array(of_gram, mask=of_gram == none)), pa.array(grams, pa.string()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[group, "gram", "n"])

    rows = df.select(group, letters(F.col(text)).alias("_letters"))
    kind = T.StructType([T.StructField(group, rows.schema[0].dataType), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    return rows.mapInArrow(run, kind).groupBy(group, "gram").agg(F.sum("n").alias("n"))


class _Scores:
    """Numbers of trigrams by code: 0 for an unknown one, the last for a place that is no letter."""

    def __init__(self, chars: np.ndarray, grams: np.ndarray, cells: int):
        self.rank = np.zeros(_CODE_POINTS, np.int64)
        self.rank[chars] = np.arange(1, len(chars) + 1)  # 0: in no known trigram
        self.size, self.blank = len(chars) + 1, len(grams) + 1
        codes = _codes(self.rank, grams.ravel(), self.size)[::3] if len(grams) else np.zeros(0, np.int64)
        self.order = np.argsort(codes)
        self.sorted = codes[self.order]
        self.table = None
        if self.size**3 <= cells:
            self.table = np.zeros(self.size**3, np.int32)
            self.table[codes] = np.arange(1, len(codes) + 1)

    def numbers(self, points: np.ndarray) -> np.ndarray:
        codes = _codes(self.rank, points, self.size)
        if self.table is not None:
            found = self.table[codes]
        elif len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, codes), len(self.sorted) - 1)
            found = np.where(self.sorted[at] == codes, self.order[at] + 1, 0)
        else:
            found = np.zeros(len(codes), np.int64)
        found[points[1:-1] == _BLANK] = self.blank
        return found


def sum_trigrams(df: DataFrame, key: str, text: str, model: DataFrame, scores: list[str], unseen: list[float]) -> DataFrame:
    """``(key, *scores)`` of every row with a letter: the sums of its trigrams' scores.

    ``model`` is ``(gram, *scores)``, small enough to be broadcast; a trigram that it does not hold scores ``unseen``.
    """
    most, cells = SLICE, CELLS
    known = model.select("gram", *scores).toArrow()
    grams = np.frombuffer("".join(known["gram"].to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, 3)
    chars = np.unique(np.append(grams.ravel(), np.uint32(_BLANK)))
    values = [np.concatenate([[miss], known[p].to_numpy(), [0.0]]) for p, miss in zip(scores, unseen, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _Scores(chars, grams, cells)
        for keys, starts, points in _slices(batches, most):
            found, at = told.numbers(points), starts[:-1] - 1
            some = pa.array(np.add.reduceat(points[1:-1] != _BLANK, at, dtype=np.int64) > 0)
            sums = [pa.array(np.add.reduceat(p[found], at)) for p in values]
            yield pa.RecordBatch.from_arrays([keys, *sums], names=[key, *scores]).filter(some)

    rows = df.select(key, letters(F.col(text)).alias("_letters"))
    kind = T.StructType([T.StructField(key, rows.schema[0].dataType), *[T.StructField(p, T.DoubleType()) for p in scores]])
    return rows.mapInArrow(run, kind)
