"""SentencePiece BPE by a table of each prefix's last token.

Merging highest score first, leftmost first, has this property: if BPE ends a text's
encoding with some token, the text before that token is encoded as if it stood alone. So every prefix
has one last token, and the table of them holds the encoding of every prefix. An automaton gives
the tokens that end at a place; the one is the last token which BPE keeps apart from the last token
before it. Whether it keeps two tokens apart is told by undoing their merges, latest first,
and looking at each step for a merge over the border that would have come earlier. The
ids are read backwards from the end of the table, so the work is linear in the text.

Pieces have the mark of a space only in front, so a text falls apart before marks that follow other characters.
"""

from __future__ import annotations

import codecs
import gc
import math
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.byte_bpe import Memo
from tabprep.llm.common import slices, text_of

#: Characters whose prefixes are tabled at once; a longer segment is tabled by itself.
TABLED = 1 << 18
#: Pairs of tokens whose compatibility a worker remembers.
PAIRS = 1 << 20

_MARK = "▁"
_SEGMENT = re.compile(f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a SentencePiece BPE model: strings and scores by id, bytes by id, begin and end.

    Small and of fixed size, so tasks carry it. Read on the driver, where a model that
    this operator does not encode as the library does is refused.
    """

    def __init__(self, scored: tuple[tuple[int, str, float], ...], of_byte: tuple[int, ...], silent: tuple[int, ...], unknown: int, begin: int, end: int):
        self.scored, self.of_byte, self.silent = scored, of_byte, silent
        self.unknown, self.begin, self.end = unknown, begin, end

    @classmethod
    def of_file(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" a  ﬁ\té ") != f"{_MARK * 2}a{_MARK * 2}ﬁ\té{_MARK}":
            raise ValueError("the model's normaliser must only mark spaces, and put one in front")
        ids = range(model.get_piece_size())
        of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        if len(of_byte) != 256 or any(map(model.is_unused, ids)):
            raise ValueError("the model must have a piece for every byte, and no unused piece")
        silent = tuple(i for i in ids if model.is_control(i))
        scored = tuple((i, model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
        known = {p for _, p, _ in scored}
        if any(c not in known for p in known for c in p) or any(_MARK in p.lstrip(_MARK) for p in known):
            raise ValueError("every character of a piece must be a piece, and marks of spaces stand in front only")
        return cls(scored, tuple(of_byte[b] for b in range(256)), silent, model.unk_id(), model.bos_id(), model.eos_id())

    def key(self) -> tuple:
        return self.scored, self.of_byte, self.silent, self.unknown, self.begin, self.end


class Merges:
    """How BPE builds each token: its place in the order of merges, and the two tokens merged last.

    ``rank`` is 0 for single characters and, for others, the place of their score. A token that
    BPE does not build from its own characters never stands in an encoding; its rank is None.
    """

    def __init__(self, scored: tuple[tuple[int, str, float], ...]):
        self.text = {i: p for i, p, _ in scored}
        self.id = {p: i for i, p, _ in scored}
        places = {s: n for n, s in enumerate(sorted({s for _, _, s in scored}, reverse=True), 1)}
        self.place = {p: places[s] for _, p, s in scored}
        shared: dict[float, int] = {}
        for _, p, s in scored:
            if len(p) > 1:
                shared[s] = shared.get(s, 0) + 1
        self.rank: dict[int, int | None] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        #: Tokens whose building has merges of equal scores, or one of a better score than its parts.
        self.odd: set[int] = set()
        for i, p, s in sorted(scored, key=lambda x: len(x[1])):
            if len(p) == 1:
                self.rank[i] = 0
                continue
            tokens, last = self.merge(p)
            if len(tokens) > 1:
                self.rank[i] = None
                continue
            self.rank[i] = self.place[p]
            self.parts[i] = a, b = self.id[p[:last]], self.id[p[last:]]
            if shared[s] > 1 or {a, b} & self.odd or max(self.rank[a], self.rank[b]) >= self.place[p]:
                self.odd.add(i)

    def merge(self, text: str) -> tuple[list[str], int]:
        """The tokens of a short text by plain merging, and where the parts of the last merge meet."""
        n, last = len(text), 0
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def look(i: int) -> None:
            middle = following[i]
            if middle < n:
                place = self.place.get(text[i : following[middle]])
                if place is not None:
                    heappush(queue, (place, i, middle, following[middle]))

        for i in range(n - 1):
            look(i)
        while queue:
            _, i, middle, end = heappop(queue)
            if following[i] != middle or following[middle] != end:
                continue
            last = middle
            following[i], following[middle] = end, -1
            if end < n:
                preceding[end] = i
                look(i)
            if preceding[i] >= 0:
                look(preceding[i])
        tokens, i = [], 0
        while i < n:
            tokens.append(text[i : following[i]])
            i = following[i]
        return tokens, last

    def apart(self, a: int, b: int) -> bool:
        """Whether BPE encodes the two tokens' joint text as these two tokens.

        Undoes the later of the two merges that made the tokens at the border, as long as there
        is one. The two stood side by side until one of them was used up; a merge of
        both that comes before would have been done. Of equal merges the left one is first.
        """
        if a in self.odd or b in self.odd:
            return self.merge(self.text[a] + self.text[b])[0] == [self.text[a], self.text[b]]
        used_a = used_b = math.inf
        while True:
            joint = self.place.get(self.text[a] + self.text[b], math.inf)
            if joint < used_a and joint <= used_b:
                return False
            made_a, made_b = self.rank[a], self.rank[b]
            if made_a > made_b:
                used_a, a = made_a, self.parts[a][1]
            elif made_b:
                used_b, b = made_b, self.parts[b][0]
            else:
                return True


class Encoder:
    """Encodes and decodes texts; keeps the ids of short segments it has met, up to a fixed number of bytes."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.pieces = pieces
        self.merges = merges = Merges(pieces.scored)
        self.automaton = ahocorasick.Automaton()
        for i, p, _ in pieces.scored:
            if merges.rank[i] is not None:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        used = set("".join(merges.id))
        self.border = next(c for c in map(chr, range(1, 1 << 16)) if c not in used)
        size = 1 + max(max(pieces.of_byte), *merges.text, *pieces.silent, pieces.unknown)
        self.length = [0] * size
        for i, p in merges.text.items():
            self.length[i] = len(p)
        self.known: list[dict[int, bool]] = [{} for _ in range(size)]
        self.pairs = 0
        self.memo = Memo(lambda segment: self.table([segment])[0])
        self.surface = [""] * size
        for i, p in merges.text.items():
            self.surface[i] = p.replace(_MARK, " ")
        self.surface[pieces.unknown] = " ⁇ "
        self.byte = {i: b for b, i in enumerate(pieces.of_byte)}
        self.first, self.last = struct.pack("<I", pieces.begin), struct.pack("<I", pieces.end)

    def table(self, segments: list[str]) -> list[bytes]:
        """The ids of some segments, from one table over all of them.

        A zero in the table is a border: a segment's start, or a character without a piece.
        """
        text = self.border.join(segments)
        last = array("i", bytes(4 * len(text) + 4))
        known, apart = self.known, self.merges.apart
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            before = last[end - size]
            if before:
                good = known[before].get(token)
                if good is None:
                    good = self.remember(before, token, apart(before, token))
                if not good:
                    continue
            last[end] = token
        out, start = [], 0
        for segment in segments:
            stop = start + len(segment)
            out.append(self.backwards(text, last, start, stop))
            start = stop + 1
        return out

    def remember(self, before: int, token: int, good: bool) -> bool:
        if self.pairs >= PAIRS:
            for row in self.known:
                row.clear()
            self.pairs = 0
        self.pairs += 1
        self.known[before][token] = good
        return good

    def backwards(self, text: str, last: array, start: int, stop: int) -> bytes:
        """The ids between two places, from the last token back to the first."""
        ids, length = [], self.length
        while stop > start:
            token = last[stop]
            if token:
                ids.append(token)
                stop -= length[token]
            else:
                stop -= 1
                ids.extend(self.pieces.of_byte[b] for b in reversed(text[stop].encode()))
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, segments: list[str]) -> None:
        """Fill the memo with the short ones of some segments, many in one table."""
        memo = self.memo
        new, held = [], 0
        for segment in segments:
            if segment not in memo and segment not in memo.older and len(segment) <= 48:
                new.append(segment)
                held += len(segment) + 1
                if held >= TABLED:
                    self._add(new)
                    new, held = [], 0
        if new:
            self._add(new)

    def _add(self, segments: list[str]) -> None:
        self.memo.learn(segments, self.table(segments))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of texts as little-endian 32-bit integers, begin and end included."""
        cut = [_SEGMENT.findall(_MARK + t.replace(" ", _MARK)) if t else [] for t in texts]
        self.learn(list({s for segments in cut for s in segments}))
        get = self.memo.__getitem__
        return [b"".join((self.first, *map(get, segments), self.last)) for segments in cut]

    def decode(self, ids: bytes) -> str:
        """The text that little-endian 32-bit ids stand for.

        Control ids are silent; the mark in front of the text goes; bytes that are no UTF-8 read as U+FFFD each.
        """
        surface, byte, silent = self.surface, self.byte, self.pieces.silent
        out: list[str] = []
        raw = bytearray()
        front, some = True, False  # at the text's start, and whether its mark has gone
        for i in np.frombuffer(ids, "<u4").tolist():
            if i in byte:
                raw.append(byte[i])
                front = False
                continue
            if raw:
                out.append(raw.decode("utf-8", "each"))
                raw.clear()
            piece = surface[i]
            if front and not some and i not in silent and i != self.pieces.unknown and piece[:1] == " ":
                piece, some = piece[1:], True
            elif front and i in silent:
                some = False
            if piece or some:
                front = False
            out.append(piece)
        if raw:
            out.append(raw.decode("utf-8", "each"))
        return "".join(out)


def _each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each", _each)


@lru_cache(maxsize=2)
def encoder_of(key: tuple) -> Encoder:
    """A Python worker's encoder, which outlives its tasks."""
    gc.set_threshold(100_000, 20, 20)
    return Encoder(Pieces(*key))


def encode(df: DataFrame, key: str, text: str, pieces: Pieces, decoded: bool = False) -> DataFrame:
    """The ids of every whole text, begin and end included: ``key, n_tokens, ids``, and on request ``decoded``.

    ``ids`` are little-endian unsigned 32-bit integers in one binary value; ``decoded`` is the
    text that they decode to, made by the same task: the text itself, but for U+2581, which reads as a space.
    Null and empty texts have begin and end only; keys may be null or repeat, each row stands for
    itself; an empty table gives an empty result; other columns are not read.

    A map over Arrow batches: rows do not move, and a task holds one slice of texts.
    """
    packed = pieces.key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(packed)
        for part in slices(batches, 1, 1 << 20):
            ids = encoder(part.column(1).to_pylist())
            out = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = ["key", "n_tokens", "ids"]
            if decoded:
                out, names = [*out, pa.array(map(encoder.decode, ids), pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded
    return df.select(F.col(key).alias("key"), text_of(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, ids: str, pieces: Pieces, out: str = "decoded") -> DataFrame:
    """The rows with the text their ids stand for, under the name ``out``.

    Null ids decode to null, no ids to the empty text. A column that is already called ``out``
    is replaced. An id outside the vocabulary fails the job.
    """
    packed = pieces.key()

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(encoder_of(packed).decode, na_action="ignore")

    return df.withColumn(out, run(F.col(ids)))
