"""Byte-level BPE by ranks, with a hierarchical-bitmap rank queue.

A pre-token is a linked list of symbols. Every adjacent pair that can merge stands in the
bucket of its rank; a hierarchy of bitmaps over the ranks gives the lowest rank in use by
find-first-set. A merge changes two pairs at most, so a pre-token of n bytes
takes about n steps however long it is. Entries whose pair has since changed are stale and
skipped when they come up.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import slices, text_of

#: Strings and bytes that a memo holds at most in each generation, and the longest of its strings in characters.
REMEMBERED, HELD_BYTES, LONGEST = 600_000, 112 << 20, 48
#: What an entry costs beside its string's and its value's own bytes: two object heads and a place in the table.
ENTRY_BYTES = 170

# fixed value: the pre-token pattern of GPT-2, for which a text may be cut at its spaces
SPACE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Vocabulary:
    """Ranks by token and the pattern of the pre-tokens; small and of fixed size, so tasks carry it."""

    def __init__(self, content: bytes, pattern: str):
        self.content, self.pattern = content, pattern

    @classmethod
    def of_file(cls, path: str, pattern: str | None = None) -> Vocabulary:
        """A rank file (base64 token and rank per line) read on the driver."""
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            return cls(f.read(), pattern)

    def ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in self.content.splitlines() if line)}


class RankQueue:
    """Merges pre-tokens: a queue of pairs, lowest rank first and leftmost first within a rank.

    Positions stand in buckets by rank. Two levels of bitmaps tell which buckets are in use:
    words over the ranks and one word over the words, both about as wide as the root of the
    number of ranks. The queue is empty again after each pre-token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        most = max(ranks.values())
        self.shift = max(1, (most.bit_length() + 1) // 2)
        self.words = [0] * ((most >> self.shift) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.mask = (1 << self.shift) - 1
        self.bit = [1 << k for k in range(max(len(self.words), 1 << self.shift))]
        #: The rank of the merge of every two bytes, or -1.
        self.pairs = [ranks.get(bytes(divmod(p, 256)), -1) for p in range(1 << 16)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        get, words, buckets, shift, mask, bit = self.ranks.get, self.words, self.buckets, self.shift, self.mask, self.bit
        n, top = len(piece), 0
        # symbol i stands for piece[i:following[i]]; rank[i] is that of its merge with the next one
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        rank = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        rank.append(-1)
        for i, r in enumerate(rank):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)  # positions come in order
                else:
                    buckets[r] = [i]
                    word = r >> shift
                    if not words[word]:
                        top |= bit[word]
                    words[word] |= bit[r & mask]
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            lowest = bits & -bits
            r = (word << shift) + lowest.bit_length() - 1
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[r]
                words[word] = bits ^ lowest
                if bits == lowest:
                    top &= top - 1
            if rank[i] != r:  # stale: one of the two has merged otherwise
                continue
            gone = following[i]
            after = following[i] = following[gone]
            rank[gone] = -1
            if after < n:
                preceding[after] = i
                rank[i] = r = get(piece[i : following[after]], -1)
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        word = r >> shift
                        if not words[word]:
                            top |= bit[word]
                        words[word] |= bit[r & mask]
            else:
                rank[i] = -1
            i = preceding[i]
            if i >= 0:
                rank[i] = r = get(piece[i:after], -1)
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        word = r >> shift
                        if not words[word]:
                            top |= bit[word]
                        words[word] |= bit[r & mask]
        out, i = [], 0
        while i < n:
            out.append(get(piece[i : following[i]]))
            i = following[i]
        return out


class Encoder:
    """Encodes texts; keeps the ids of short strings it has met, up to a fixed number of bytes.

    Under ``SPACE_PATTERN`` a text is cut at its spaces, and a piece with the space before it is
    one string of the memo, as are its pre-tokens. Texts under another pattern, and texts with blanks side by
    side or at their ends, are taken by pre-tokens.
    """

    def __init__(self, vocabulary: Vocabulary, held_bytes: int | None = None):
        import regex

        self.ranks = vocabulary.ranks()
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.queue = RankQueue(self.ranks)
        self.split = regex.compile(vocabulary.pattern).findall
        self.blank = regex.compile(r"\s").match
        self.cuts = vocabulary.pattern == SPACE_PATTERN
        self.memo = Memo(self.piece, most_bytes=held_bytes)

    def pretoken(self, piece: str) -> bytes:
        """The ids of one pre-token as little-endian 32-bit integers."""
        raw = piece.encode()
        whole = self.ranks.get(raw)
        ids = self.queue.merge(raw) if whole is None else (whole,)
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes | None:
        """The ids of a piece with the space before it, if any; None if it begins or ends with a blank otherwise."""
        inner = piece[1:] if piece[:1] == " " else piece
        if not inner or self.blank(inner[0]) or self.blank(inner[-1]):
            return None
        parts = self.split(piece)
        return self.pretoken(piece) if len(parts) == 1 else self.by_pretokens(parts)

    def by_pretokens(self, parts: list[str]) -> bytes:
        known, make = self.memo.__getitem__, self.pretoken
        return b"".join([known(p) or make(p) for p in parts])

    def __call__(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.cuts:
            first, *later = text.split(" ")
            try:
                return b"".join(map(self.memo.__getitem__, [first, *[" " + p for p in later]]))
            except TypeError:  # a piece without ids of its own
                pass
        return self.by_pretokens(self.split(text))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian 32-bit ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Memo(dict):
    """What a function gave for short strings, in two generations of bounded size.

    When the younger is full, by entries or by bytes, it replaces the older, so what is met again
    and again stays.
    """

    def __init__(self, make: Callable[[str], bytes | None], most: int | None = None, most_bytes: int | None = None):
        super().__init__()
        self.make, self.most, self.older, self.held = make, most or REMEMBERED, {}, 0
        self.most_bytes = most_bytes or HELD_BYTES

    def __missing__(self, key: str) -> bytes | None:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            size = ENTRY_BYTES + len(key) + len(value or b"")
            if len(self) >= self.most or self.held + size > self.most_bytes:
                self.age()
            self[key] = value
            self.held += size
        return value

    def learn(self, keys: list[str], values: list[bytes]) -> None:
        """Take in what was made elsewhere for some short strings."""
        self.make_room(len(keys))
        self.update(zip(keys, values, strict=True))
        self.held += sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)

    def age(self) -> None:
        self.older = dict(self)
        self.clear()
        self.held = 0

    def make_room(self, n: int) -> None:
        if self and (len(self) + n > self.most or self.held + n * ENTRY_BYTES > self.most_bytes):
            self.age()


class Pieces(Memo):
    """Ids of the pieces between the spaces of a text.

    A pre-token reaches over a space only if other blanks stand beside it. So where pieces
    neither begin nor end with a blank, each may be encoded by itself, the space before it
    included. Any other piece has None.
    """

    def __init__(self, encode: Callable[[str], bytes], before: str, blank: Callable, most: int | None = None):
        super().__init__(lambda piece: encode(before + piece) if piece and not blank(piece[0]) and not blank(piece[-1]) else None, most)


@lru_cache(maxsize=2)
def encoder_of(content: bytes, pattern: str, held_bytes: int | None = None) -> Encoder:
    """A Python worker's encoder, which outlives its tasks.

    Encoding makes many small lists and no cycles, so the collector may come by less often.
    """
    gc.set_threshold(100_000, 20, 20)
    return Encoder(Vocabulary(content, pattern), held_bytes)


def encode(df: DataFrame, key: str, text: str, vocabulary: Vocabulary, decoded: bool = False, held_bytes: int | None = None) -> DataFrame:
    """The token ids of every whole text: ``key, n_tokens, ids``, and on request ``decoded``.

    ``ids`` are little-endian unsigned 32-bit integers in one binary value; ``decoded`` are the
    bytes that they decode to, made by the same task. Null and empty texts have no tokens;
    keys may be null or repeat, each row stands for itself; an empty table gives an empty
    result; other columns are not read. Special tokens are not looked for.

    A map over Arrow batches: rows do not move, and a task holds one slice of texts. A worker's memo holds
    ``held_bytes`` in each of two generations, or ``HELD_BYTES``.
    """
    content, pattern = vocabulary.content, vocabulary.pattern

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content, pattern, held_bytes)
        for part in slices(batches, 1):
            ids = list(map(encoder, part.column(1).to_pylist()))
            out = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = ["key", "n_tokens", "ids"]
            if decoded:
                out, names = [*out, pa.array(map(encoder.decode, ids), pa.binary())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decoded
    return df.select(F.col(key).alias("key"), text_of(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, ids: str, vocabulary: Vocabulary, out: str = "decoded") -> DataFrame:
    """The rows with the bytes their token ids stand for, under the name ``out``.

    Null ids decode to null, no ids to no bytes. A column that is already called ``out`` is replaced.
    An id outside the vocabulary fails the job.
    """
    content, pattern = vocabulary.content, vocabulary.pattern

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        return column.map(encoder_of(content, pattern).decode, na_action="ignore")

    return df.withColumn(out, run(F.col(ids)))
