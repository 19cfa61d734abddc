"""Near-duplicates by SimHash, searched with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. The perfect binary Golay
code (23, 12) decodes any segment to one codeword; a segment and its one-bit neighbours
decode to about six codewords, and two segments that differ in one bit share one of them.

Of at most two differing bits, some two segments hold none and at most one: errors in three
segments sum up over the three pairs of segments to twice their number, so one pair holds no
more than one. A fingerprint is therefore filed under (exact segment, codeword of another
segment) for the six ordered pairs, and looked up under (exact segment, each nearby codeword).
Pairs that meet are verified by their bit distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import map_arrow, numbered, stored, text_of
from tabprep.llm.components import components

#: Seed of the shingle hash.
SEED = 42
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
#: Lowest bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: The largest bit distance that three segments and one-bit probes cover.
MOST_BITS = 2
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def _remainders(width: int, shift: int) -> np.ndarray:
    """x * 2**shift modulo the generator, for all x of a width; linear, so built by doubling."""
    out = np.zeros(1, np.uint32)
    for bit in range(shift, shift + width):
        r = 1 << bit
        for k in range(bit, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        out = np.concatenate([out, out ^ np.uint32(r)])
    return out


class Golay:
    """Decodes 23-bit words to the 12-bit index of the only codeword within three bits."""

    def __init__(self):
        self.low, self.high = _remainders(12, 0), _remainders(11, 12)
        self.error = np.zeros(1 << 11, np.uint32)
        units = [1 << i for i in range(23)]
        patterns = [0] + units
        patterns += [a | b for i, a in enumerate(units) for b in units[:i]]
        patterns += [a | b | c for i, a in enumerate(units) for j, b in enumerate(units[:i]) for c in units[:j]]
        patterns = np.array(patterns, np.uint32)
        self.error[self.syndrome(patterns)] = patterns

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 0xFFF] ^ self.high[words >> 12]

    def index(self, words: np.ndarray) -> np.ndarray:
        return ((words ^ self.error[self.syndrome(words)]) >> 11).astype(np.int64)


def shingles(text: str, length: int) -> list[bytes]:
    """Word shingles of a text: A-Z lowered, words between ASCII white space, repeats kept."""
    words = text.encode().lower().split()
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    return [joined[a:b] for a, b in zip(starts[: len(words) - length + 1].tolist(), (ends[length - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: str, length: int) -> int:
    """The bits set in more than half of the shingles' hashes; zero without words."""
    from xxhash import xxh64_intdigest

    parts = shingles(text, length)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(parts), COUNTED):
        hashes = np.array([xxh64_intdigest(s, SEED) for s in parts[at : at + COUNTED]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(parts), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, key: str, text: str, length: int = 3) -> DataFrame:
    """``key, fp``: the SimHash of each whole text as a signed 64-bit integer.

    Null and empty texts have fingerprint zero. A map over Arrow batches.
    """

    def run(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, length) for t in batch.column(1).to_pylist()], np.uint64)
        return {"key": batch.column(0), "fp": found.view(np.int64)}

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(F.col(key).alias("key"), text_of(text).alias("text")), run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def _filed(batch: pa.RecordBatch, probes: bool) -> pa.RecordBatch:
    """(place, fp) of distinct fingerprints: one per pair of segments, or one per nearby codeword."""
    code = Golay()
    signed = batch.column(0).to_numpy()
    fp = signed.view(np.uint64)
    parts = [((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.uint32) for low, width in SEGMENTS]
    places, owners = [], []
    for j, (_, width) in enumerate(SEGMENTS):
        flips = [0] + [1 << b for b in range(width)] if probes else [0]
        codes = np.stack([code.index(parts[j] ^ np.uint32(f)) for f in flips], axis=1)
        codes.sort(axis=1)
        new = np.ones(codes.shape, bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, column = np.nonzero(new)
        for i in range(3):
            if i != j:
                places.append(((3 * i + j) << 34) | (parts[i][row].astype(np.int64) << 12) | codes[row, column])
                owners.append(signed[row])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(places)), pa.array(np.concatenate(owners))], names=["place", "fp"])


def _file(prints: DataFrame, probes: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _filed(batch, probes)

    return prints.select("fp").mapInArrow(run, "place bigint, fp bigint")


def links(prints: DataFrame, bits: int) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints (column ``fp``) that differ in at most ``bits`` bits.

    Spark sizes both sides by the fingerprints they are made of, of which each is filed six times and looked up about
    forty times, so the join is told not to broadcast either.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"three Golay segments cover at most {MOST_BITS} differing bits")
    filed = _file(prints, False).withColumnRenamed("fp", "a")
    sought = _file(prints, True).withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    return filed.join(sought.hint("merge"), "place").filter(near).select("a", "b").distinct()


def groups(df: DataFrame, key: str, text: str, length: int = 3, bits: int = 2) -> DataFrame:
    """``key, fp, component``: near-duplicate groups of whole documents.

    ``component`` is the smallest key that can be reached over links of at most ``bits``
    differing bits. Documents without words have fingerprint zero and link like any other.
    Null keys never name a group; a group of null keys only has a null component. Repeated rows stay.
    An empty table gives an empty result; other columns are not read.

    Documents with one fingerprint are one class: only distinct fingerprints are searched,
    so thousands of copies cost one row.
    """
    rows = stored(fingerprints(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", length), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("key").alias("least"))
    tied = components(links(prints, bits), "a", "b").withColumnRenamed("node", "fp")
    # a row per document or fingerprint: as packed files these look small enough to broadcast long after they are not
    classes = prints.join(tied.hint("merge"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = classes.groupBy("component").agg(F.min("least").alias("name"))
    found = classes.join(named.hint("merge"), "component").select("fp", F.col("name").alias("component"))
    return rows.join(found.hint("merge"), "fp").select(F.col("key").alias(key), "fp", "component")


def keep_one(df: DataFrame, key: str, text: str, length: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``df``, one of each near-duplicate group: that with the smallest key.

    Null keys come last; of repeated keys one row stays. All columns are kept.
    """
    docs, row = numbered(df, "documents")
    found = groups(docs, row, text, length, bits).select(F.col(row).alias("row"), F.col("component").alias("group"))
    keys = docs.select(F.col(row).alias("row"), F.col(key).alias("key"))
    first = keys.join(found, "row").groupBy("group").agg(F.min(F.struct(F.col("key").isNull(), "key", "row")).alias("first"))
    return docs.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*(F.col(f"`{c}`") for c in df.columns))
