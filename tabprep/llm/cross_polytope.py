"""Near-duplicate vectors by cross-polytope hashing.

Andoni et al., "Practical and Optimal LSH for Angular Distance" (2015). A vector is rotated by
three rounds of random signs and a fast Hadamard transform; the largest coordinate with its
sign is its hash. A table's key joins some hashes; multiprobe adds the keys with one hash
replaced by the runner-up. Vectors that share a bucket of a table are candidates, and their
cosine is taken in double precision.

Equal vectors are one class. Buckets are cut into blocks of bounded size and every two blocks
of a bucket meet in one task, where all their cosines are one matrix product. A task gives
per vector how many it links with, and a spanning forest of the links; pairs are never rows.
A pair that meets in several buckets counts in the first one they share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stored
from tabprep.llm.components import components

#: Wanted chance that a pair at the threshold shares a bucket.
RECALL = 0.9995
#: Vectors per bucket if they were spread evenly, at most; rows of a block.
LOAD, BLOCK = 32, 1024
SEED = 42


@dataclass(frozen=True)
class Scheme:
    """Hashes per table, and tables, for vectors of ``size`` numbers (a power of two)."""

    size: int
    hashes: int
    tables: int

    @classmethod
    def of(cls, width: int, rows: int, cosine: float) -> Scheme:
        """Hashes by the number of rows; tables by the rate at which simulated pairs at the threshold meet.

        So few rows as one bucket may hold are not hashed: all of them meet.
        """
        size = 1 << max(1, (width - 1).bit_length())
        if rows <= LOAD:
            return cls(size, 0, 1)
        hashes = max(1, math.ceil(math.log(max(2.0, rows / LOAD)) / math.log(2 * size)))
        r = np.random.default_rng(SEED)
        a, b = r.normal(size=(2, 4000, size))
        a[:, width:] = b[:, width:] = 0
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = cosine * a + math.sqrt(1 - cosine * cosine) * b / np.linalg.norm(b, axis=1, keepdims=True)
        one = cls(size, hashes, 1)
        rate = float(np.mean((one.keys(a)[:, 0, :, None] == one.keys(b)[:, 0, None, :]).any(axis=(1, 2))))
        rate = min(max(rate, 1e-3), 0.999)
        return cls(size, hashes, max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - rate))))

    def keys(self, x: np.ndarray, tables: int | None = None) -> np.ndarray:
        """Buckets of each vector: rows x tables x (1 + hashes), the vector's own bucket first.

        On request those of the first tables alone. All rotations of some rows are one transform.
        """
        tables = tables or self.tables
        out = np.empty((len(x), tables, 1 + self.hashes), np.int64)
        out[:] = np.arange(tables)[None, :, None]
        if not self.hashes:
            return out
        turns = tables * self.hashes
        signs = _signs(self.size, self.hashes, self.tables)[:tables].reshape(turns, 3, self.size)
        step = max(1, AT_ONCE // (turns * self.size))
        for start in range(0, len(x), step):
            own = x[start : start + step]
            y = np.zeros((len(own), turns, self.size))
            y[:, :, : x.shape[1]] = own[:, None, :]
            for turn in range(3):
                y = _hadamard((y * signs[None, :, turn]).reshape(-1, self.size)).reshape(y.shape)
            y = y.reshape(-1, self.size)
            rows = np.arange(len(y))
            strength = np.abs(y)
            two = np.argpartition(strength, -2, axis=1)[:, -2:]
            order = np.take_along_axis(strength, two, axis=1)
            first = np.where(order[:, 0] > order[:, 1], two[:, 0], two[:, 1])
            second = two.sum(axis=1) - first
            best = (2 * first + (y[rows, first] < 0)).reshape(len(own), tables, self.hashes)
            next_ = (2 * second + (y[rows, second] < 0)).reshape(len(own), tables, self.hashes)
            for probe in range(1 + self.hashes):
                key = out[start : start + step, :, probe]
                for h in range(self.hashes):
                    key = key * (2 * self.size) + (next_ if probe == h + 1 else best)[:, :, h]
                out[start : start + step, :, probe] = key
        return out


#: Numbers that are rotated at once.
AT_ONCE = 1 << 20


@lru_cache(maxsize=8)
def _signs(size: int, hashes: int, tables: int) -> np.ndarray:
    """Random signs of every table and hash; a worker draws them once."""
    return np.stack([np.random.default_rng((SEED, t)).choice([-1.0, 1.0], size=(hashes, 3, size)) for t in range(tables)])


class Schemes:
    """The schemes of all lengths of vectors, each with a range of bucket keys of its own."""

    def __init__(self, by_width: dict[int, Scheme]):
        self.widths = sorted(by_width)
        self.schemes = [by_width[w] for w in self.widths]
        ends = [0]
        for s in self.schemes:
            ends.append(ends[-1] + s.tables * (2 * s.size) ** s.hashes)
        self.starts = np.array(ends[:-1], np.int64)

    def keys(self, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By length: places of its vectors, and their buckets, a row for each vector."""
        width = np.diff(vectors.offsets.to_numpy())
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            n = np.searchsorted(self.widths, w)
            x = _matrix(vectors.take(pa.array(at)) if len(at) < len(vectors) else vectors)
            yield at, self.starts[n] + self.schemes[n].keys(x).reshape(len(at), -1)

    def of_key(self, key: int) -> tuple[Scheme, int]:
        """The scheme that a bucket belongs to, and its key there."""
        n = int(np.searchsorted(self.starts, key, side="right")) - 1
        return self.schemes[n], key - int(self.starts[n])


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, unscaled."""
    n, d = x.shape
    h = 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = values.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither tiny nor huge numbers lose their norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links(scheme: Scheme, key: int, x: np.ndarray, node: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float):
    """Links between two blocks of a bucket: nodes, how many vectors each links with, and a forest."""
    near = (x @ x.T) >= cosine
    # a block meets itself once, and another block in one direction
    near &= left[:, None] & right[None, :]
    near &= node[:, None] != node[None, :]
    near |= near.T
    a, b = np.nonzero(np.triu(near))
    if not len(a):
        return None
    used = np.unique(np.concatenate([a, b]))
    place = np.zeros(len(x), np.int64)
    place[used] = np.arange(len(used))
    table = key // (2 * scheme.size) ** scheme.hashes
    keys = scheme.keys(x[used], table + 1)
    n = np.zeros(len(used), np.int64)
    for at in range(0, len(a), 1 << 14):
        i, j = place[a[at : at + (1 << 14)]], place[b[at : at + (1 << 14)]]
        earlier = np.zeros(len(i), bool)
        for t in range(table + 1):
            same = keys[i, t, :, None] == keys[j, t, None, :]
            if t == table:
                same &= keys[i, t, :, None] < key
            earlier |= same.any(axis=(1, 2))
        i, j = i[~earlier], j[~earlier]
        n += np.bincount(i, weights=size[used][j], minlength=len(used)).astype(np.int64)
        n += np.bincount(j, weights=size[used][i], minlength=len(used)).astype(np.int64)
    label = np.arange(len(used))
    links = near[np.ix_(used, used)]
    while True:
        least = np.minimum(label, np.where(links, label[None, :], len(used)).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    return node[used], n, node[used][label]


def neighbours(df: DataFrame, key: str, vector: str, cosine: float = 0.9) -> DataFrame:
    """``key, n_links, component``: links and groups of all vectors at a cosine of at least ``cosine``.

    ``n_links`` counts the other rows linked directly; ``component`` is the smallest key that
    can be reached, the row's own included. Vectors that are null, empty, zero or hold null or
    non-finite numbers, and vectors of different lengths, do not link. Repeated rows link with
    each other. Null keys never name a component of others. An empty table gives an empty
    result; other columns are not read. Links below RECALL of sharing a bucket may be missed,
    none is ever wrong.
    """
    v = F.col(vector)
    sound = (
        v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    )
    digest = F.sha2(F.concat_ws(",", v.cast("array<string>")), 256)
    rows = df.select(F.col(key).alias("key"), F.when(F.coalesce(sound, F.lit(False)), digest).alias("digest"), v.alias("vector"))
    classes = stored(
        rows.filter("digest is not null").groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("size"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    plain = rows.select("key", "digest")
    schemes = _schemes(classes, cosine)
    if not schemes.widths:
        return plain.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    found = stored(_counted(classes, schemes, cosine), "links")
    n = found.groupBy("node").agg(F.sum("n").alias("n"))
    tied = components(found.filter("node != root"), "node", "root")
    named = classes.select("node", "digest", "least", "size").join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    told = named.join(names, "component").join(n, "node", "left").select("digest", "name", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return plain.join(told, "digest", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("name")).alias("component")
    )


def _schemes(classes: DataFrame, cosine: float) -> Schemes:
    """The scheme of every length, simulated on the executors.

    The driver and the tasks hold a few numbers per length. k different lengths make up a table of at
    least k * (k + 1) / 2 numbers, so what they hold grows with the root of the input at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(w, Scheme.of(w, n, cosine)) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist([{"width": w, "size": s.size, "hashes": s.hashes, "tables": s.tables} for w, s in made], schema=SCHEME)

    lengths = classes.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    dealt = lengths.repartition(classes.sparkSession.sparkContext.defaultParallelism, "width")
    found = dealt.mapInArrow(run, "width int, size bigint, hashes int, tables int").collect()
    return Schemes({r["width"]: Scheme(r["size"], r["hashes"], r["tables"]) for r in found})


SCHEME = pa.schema([("width", pa.int32()), ("size", pa.int64()), ("hashes", pa.int32()), ("tables", pa.int32())])


def _counted(classes: DataFrame, schemes: Schemes, cosine: float) -> DataFrame:
    """``node, n, root``: counts and forests of the blocks; a node may stand in many rows."""
    shared = classes.sparkSession.sparkContext.broadcast(schemes)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                nodes = part.column(0).to_numpy()
                for own, keys in shared.value.keys(part.column(1)):
                    node = np.repeat(nodes[own], keys.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(node)], names=["key", "node"])

    filed = stored(classes.select("node", "vector").mapInArrow(file, "key bigint, node bigint"), "buckets")
    # buckets with one vector hold no pair
    loads = filed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = filed.join(loads, "key").select("key", "node", "blocks", block.alias("block"))
    meets = placed.select("key", "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block"
    )
    carried = meets.join(classes.select("node", "size", "vector"), "node").select("key", "i", "j", "block", "node", "size", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches):
            key, i, j = (part.column(c)[0].as_py() for c in range(3))
            block = part.column(3).to_numpy()
            scheme, key = shared.value.of_key(key)
            got = _links(
                scheme, key, _matrix(part.column(6)), part.column(4).to_numpy(), part.column(5).to_numpy(), block == i, block == j, cosine
            )
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["node", "n", "root"])

    dealt = carried.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "node bigint, n bigint, root bigint")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that agree in their first three columns, from ordered batches; alone ones are left out."""
    held: list[pa.RecordBatch] = []
    last = None

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
        starts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1, [len(ids)]])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            now = tuple(ids[a])
            if held and now != last:
                if sum(h.num_rows for h in held) > 1:
                    yield whole()
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held and sum(h.num_rows for h in held) > 1:
        yield whole()
