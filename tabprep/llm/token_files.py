"""Token-id files with Elias-Fano document boundaries.

A file is one array of ids and the n + 1 borders of its n documents. The borders ascend, so
they are stored in about 2 + log2(ids / documents) bits each: the low bits packed, the high
bits as ones in a bit vector. A border is found by select: a sample of the positions of every
512th one leads to the word that holds it. No table of 64-bit offsets is kept.

Layout, little endian: magic, version, bytes per id, low bits per border, documents, ids,
then for each section its length, then the sections: keys (an Arrow stream), low bits, high
bits, samples, ids.
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress, count
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.byte_bpe import LONGEST, Memo, Pieces
from tabprep.llm.common import map_arrow, slices, stored, text_of
from tabprep.llm.files import new_folder, new_name, reader, write

MAGIC, VERSION = b"TKEF", 1
HEAD = struct.Struct("<4sBBBxQQ5Q")
#: Ones between two samples.
EVERY = 512
#: Pieces that a worker's memos hold in each generation: behind a space, and at the start of a text or line.
REMEMBERED, REMEMBERED_FIRST = 800_000, 100_000
#: What may stand behind a word as one pre-token. An apostrophe may not: it takes letters along.
MARKS = "".join(c for c in string.punctuation if c != "'")
#: Letters up to here are letters in any version of Unicode's tables.
OLD_LETTERS = "\u024f"
#: Whether a text is words of such letters, each behind one space.
plain_words = re.compile("(?: [A-Za-zªµºÀ-ÖØ-öø-\u024f]++)++").fullmatch
#: Bytes of text encoded at once for a file: few enough that its pieces stay in a core's cache.
SLICE = 512 << 10
#: Bytes of ids after which a file is closed.
FILE = 16 << 20


class EliasFano:
    """Ascending numbers in near-minimal space with access by position."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.reshape(-1), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) // 64 + 1 if n else 0, np.uint64)
        np.bitwise_or.at(high, ones >> 6, np.uint64(1) << (ones & 63).astype(np.uint64))
        return cls(n, low_bits, low, high, ones[::EVERY].astype(np.uint32))

    def select(self, i: np.ndarray) -> np.ndarray:
        """Positions of the i-th ones of the high bits."""
        i = np.asarray(i, np.int64)
        at = self.samples[i // EVERY].astype(np.int64)
        word, left = at >> 6, i % EVERY
        # ones of the sample's word that stand before the sample count as passed
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        left = left + np.bitwise_count(self.high[word] & below) if len(i) else left
        moving = np.arange(len(i))
        while len(moving):
            here = np.bitwise_count(self.high[word[moving]]).astype(np.int64)
            beyond = left[moving] >= here
            moving = moving[beyond]
            left[moving] -= here[beyond]
            word[moving] += 1
        bits = np.unpackbits(self.high[word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = np.argmax(np.cumsum(bits, axis=1, dtype=np.int64) == (left + 1)[:, None], axis=1) if len(i) else left
        return (word << 6) + inside

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers, for an array of positions."""
        i = np.asarray(i, np.int64)
        high = self.select(i) - i
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) if self.low_bits else np.zeros((len(i), 0), np.uint8)
        return (high << self.low_bits) + (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1, dtype=np.int64)


def pack(keys: pa.Array, ids: list[bytes], width: int) -> bytes:
    """A file's content; ``ids`` holds each document's ids, ``width`` bytes each."""
    borders = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])])
    if borders[-1] >= 1 << 32:
        raise ValueError("a file holds fewer than 2**32 ids")
    table = EliasFano.of(borders)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("key", keys.type)])) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([keys], names=["key"]))
    parts = [sink.getvalue().to_pybytes(), table.low.tobytes(), table.high.astype("<u8").tobytes(), table.samples.astype("<u4").tobytes(), b"".join(ids)]
    return b"".join([HEAD.pack(MAGIC, VERSION, width, table.low_bits, len(ids), int(borders[-1]), *map(len, parts)), *parts])


class TokenFile:
    """An open file: its keys, and any document's ids by position."""

    def __init__(self, address: str):
        self.file = reader(address)
        magic, version, self.width, low_bits, self.documents, self.ids, *sizes = HEAD.unpack(self.file.read(HEAD.size))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError(f"{address} is not a token file")
        parts = [self.file.read(n) for n in sizes[:4]]
        self.keys = pa.ipc.open_stream(parts[0]).read_all().column(0).combine_chunks()
        self.borders = EliasFano(
            self.documents + 1, low_bits, np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<u8"), np.frombuffer(parts[3], "<u4")
        )
        self.start = HEAD.size + sum(sizes[:4])

    def read(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents first to last: their ids in one array, and its borders."""
        borders = self.borders[np.arange(first, last + 1)]
        self.file.seek(self.start + int(borders[0]) * self.width)
        raw = self.file.read(int(borders[-1] - borders[0]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}"), borders

    def close(self) -> None:
        self.file.close()


@dataclass(frozen=True)
class Tokenizer:
    """A byte-level BPE tokenizer file, the id that ends each document, and the bytes per id."""

    model: str
    end: int
    width: int

    @classmethod
    def of_file(cls, path: str, end: int) -> Tokenizer:
        import tokenizers

        with open(path, encoding="utf-8") as f:
            model = f.read()
        if not splits_at_spaces(model):
            raise ValueError("only byte-level BPE without a normaliser is supported")
        most = max(end, *tokenizers.Tokenizer.from_str(model).get_vocab().values())
        return cls(model, end, 2 if most < 1 << 16 else 4)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids and the end id, little endian. The string of an added token is that token, as in the library's plain call."""
        last = self.end.to_bytes(self.width, "little")
        return [ids + last for ids in _worker(self)(texts)]


class _Worker:
    """A loaded tokenizer, with the ids of short pieces kept.

    Pieces are encoded without the added tokens; a text that holds an added token's string goes whole
    through the full tokenizer, which is loaded when the first such text comes.
    """

    def __init__(self, told: Tokenizer):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        import tokenizers

        self.kind, self.told, self.full = f"<u{told.width}", told, None
        model = json.loads(told.model)
        self.added = [x["content"] for x in model.get("added_tokens") or [] if x["content"]]
        self.model = tokenizers.Tokenizer.from_str(json.dumps(model | {"added_tokens": []}))
        tokens = self.model.get_vocab(with_added_tokens=False)
        # how a space and the letters beyond ASCII are written in tokens
        written = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.space = written(" ")[0][0]
        self.letters = {i: written(chr(i))[0][0] for i in range(0x80, ord(OLD_LETTERS) + 1)}
        self.after_space = np.zeros(max(tokens.values()) + 1, bool)
        self.after_space[[i for token, i in tokens.items() if token.startswith(self.space)]] = True
        self.first, self.later = Pieces(self.text, "", _blank, REMEMBERED_FIRST), Pieces(self.text, " ", _blank, REMEMBERED)
        self.marks, self.line = Memo(self.text, REMEMBERED_FIRST), self.text("\n")

    def ids(self, text: str) -> np.ndarray:
        if plain_words(text):  # each is one pre-token with the space before it, so the model takes it without the splitter
            tokenize, space = self.model.model.tokenize, self.space
            words = (text if text.isascii() else text.translate(self.letters)).split(" ")
            return np.array([token.id for word in words[1:] for token in tokenize(space + word)], self.kind)
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def text(self, text: str) -> bytes:
        return self.ids(text).tobytes()

    def learn(self, new: set[str]) -> None:
        """Encode unknown pieces in one go; a token that starts with a space starts a piece.

        A word with marks behind it is two pre-tokens, and a single line break between two that are not blank is one
        of its own, so the ids of such pieces follow from those of their parts.
        """
        later = self.later
        later.make_room(len(new))  # first, since it drops the older generation: nothing found below is lost again
        older = later.older
        words, lines, stems, alone, others = [], {}, {}, set(), set()
        for p, ids in zip(new, map(older.get, new), strict=True):
            if ids:
                later[p] = ids
            elif len(p) <= LONGEST:
                if "\n" in p and all(x := p.split("\n")) and all([y.strip() == y for y in x]):
                    lines[p] = x
                else:
                    words.append(p)
        words += [x[0] for x in lines.values() if x[0] not in later and x[0] not in older]
        for p in words:
            stem = p if p.isalpha() else p.rstrip(MARKS)
            if not stem.isalpha() or not stem.isascii() and max(stem) > OLD_LETTERS:
                others.add(p)
                continue
            if stem != p:
                stems[p] = stem
                if stem in later or stem in older:
                    continue
            alone.add(stem)
        for part in (alone, others):
            later.update(self.each(list(part), " "))
        later.update([(p, later[stem] + self.marks[p[len(stem) :]]) for p, stem in stems.items()])
        starts = {y for x in lines.values() for y in x[1:] if y not in self.first}
        self.first.make_room(len(starts))
        self.first.update(self.each([y for y in starts if y not in self.first.older], "\n"))
        for p, x in lines.items():
            later[p] = self.line.join([later[x[0]], *[self.first[y] for y in x[1:]]])

    def each(self, pieces: list[str], before: str) -> Iterator[tuple[str, bytes]]:
        """Pieces and their ids, encoded many at once: behind a space, which their first token takes in, or on a line each."""
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            ids = self.ids(before + before.join(part))
            raw, size = ids.tobytes(), ids.itemsize
            if before == " ":
                starts = np.flatnonzero(self.after_space[ids]) * size
                ends = starts[1:]
            else:
                line = np.flatnonzero(ids == np.frombuffer(self.line, self.kind)[0]) * size
                starts, ends = line + size, line[1:]
            yield from zip(part, (raw[a:b] for a, b in zip(starts.tolist(), [*ends.tolist(), len(raw)], strict=True)), strict=True)

    def with_added(self, text: str) -> bytes:
        """The ids of a text that holds an added token's string."""
        if self.full is None:
            import tokenizers

            self.full = tokenizers.Tokenizer.from_str(self.told.model)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids. Its pieces are looked up once, and only unknown ones are kept until all texts have been read."""
        first, get = self.first, self.later.get
        out, gaps, new = [], [], set()
        for text in texts:
            if not text:
                out.append(b"")
                continue
            if any([x in text for x in self.added]):
                out.append(self.with_added(text))
                continue
            pieces = text.split(" ")
            ids = list(map(get, pieces))
            ids[0] = first[pieces[0]]
            if all(ids):
                out.append(b"".join(ids))
                continue
            at = list(compress(count(), map(not_, ids)))
            absent = [pieces[i] for i in at]
            if ids[0] is None or not all(absent) or any([p.strip() != p for p in absent]):  # blanks side by side or at an end
                out.append(self.text(text))
                continue
            gaps.append((len(out), ids, at, absent))
            new.update(absent)
            out.append(b"")
        self.learn(new)
        later = self.later
        for place, ids, at, absent in gaps:
            for i, p in zip(at, absent, strict=True):
                ids[i] = later[p]
            out[place] = b"".join(ids)
        return out


def _blank(character: str) -> bool:
    return character.isspace()


@lru_cache(maxsize=1)
def _worker(told: Tokenizer) -> _Worker:
    """A Python worker's tokenizer, which outlives its tasks.

    Its memos hold many objects and no cycles, so the collector may come by less often.
    """
    gc.set_threshold(100_000, 20, 20)
    return _Worker(told)


def splits_at_spaces(model: str) -> bool:
    """Whether a tokenizer file is byte-level BPE without a normaliser, so that pieces between spaces encode alone."""
    told = json.loads(model)
    before = told.get("pre_tokenizer") or {}
    return told.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")


def tokenize(df: DataFrame, key: str, text: str, tokenizer: Tokenizer) -> DataFrame:
    """``key, ids``: every whole text's ids, the end id appended. Null and empty texts hold the end id alone."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"key": batch.column(0), "ids": tokenizer(batch.column(1).to_pylist())}

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(F.col(key).alias("key"), text_of(text).alias("text")), run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def write_files(docs: DataFrame, key: str, text: str, tokenizer: Tokenizer) -> DataFrame:
    """Write the documents' ids in ascending key order; returns the manifest ``file, documents, start``.

    Null keys come first; equal keys stand side by side. ``start`` is the number of ids in
    all files before. Null and empty texts hold the end id alone; an empty table gives no file.

    Texts are dealt by ranges of the key and encoded where their file is written, so that
    finding the ranges does not encode them. A task holds one file at a time.
    """
    where = new_folder(docs.sparkSession, "tokens")
    width = tokenizer.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        keys, held, size = [], [], 0

        def close() -> pa.RecordBatch:
            address = new_name(where, ".tokens")
            write(address, pack(pa.concat_arrays(keys), held, width))
            row = {"part": part, "seq": seq, "file": address, "documents": len(held), "ids": size // width}
            return pa.RecordBatch.from_pylist([row], schema=MANIFEST)

        for batch in slices(batches, 1, SLICE):
            more = tokenizer(batch.column(1).to_pylist())
            if held and size + sum(map(len, more)) > FILE:
                yield close()
                keys, held, size, seq = [], [], 0, seq + 1
            keys.append(batch.column(0))
            held += more
            size += sum(map(len, more))
        if held:
            yield close()

    ordered = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).repartitionByRange("key").sortWithinPartitions("key")
    files = stored(ordered.mapInArrow(run, "part int, seq int, file string, documents bigint, ids bigint"), "manifest")
    # one row per task here, one row per file of a task below
    parts = files.groupBy("part").agg(F.sum("ids").alias("n"))
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    within = F.sum("ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    return files.join(offsets, "part").select("file", "documents", (F.col("ahead") + F.coalesce(within, F.lit(0))).alias("start"))


#: Tasks at most that read files.
MOST_TASKS = 20_000

MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])


def read_files(manifest: DataFrame, key: str, kind: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, from the files; ``kind`` is the key's type.

    The checksum is that of the ids as little-endian unsigned 32-bit integers. A task holds
    some documents of one file at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(address)
                for first in range(0, file.documents, 2048):
                    last = min(file.documents, first + 2048)
                    ids, borders = file.read(first, last)
                    wide, at = ids.astype("<u4"), borders - borders[0]
                    sums = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [file.keys.slice(first, last - first), pa.array(borders[:-1] + start), pa.array(np.diff(borders)), pa.array(sums, pa.int64())],
                        names=["key", "start", "n_tokens", "ids_crc32"],
                    )
                file.close()

    # one task a file: rows this small would be merged into one task otherwise
    files = manifest.select("file", "start").repartition(min(MOST_TASKS, max(1, manifest.count())))
    return files.mapInArrow(run, f"key {kind}, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("key", key)
