"""Centroid clustering of whole-number vectors with a pivot table (LAESA).

Micó, Oncina and Vidal, "A new version of the nearest-neighbour approximating and eliminating
search algorithm with linear preprocessing time and memory requirements" (1994). The first
centroids are the pivots. Every vector's distances to them are computed once and stored beside it;
in each round the difference between a vector's and a centroid's distance to a pivot
bounds their distance from below, and only centroids that no pivot rules out are measured, in exact
integers. A centroid stays near the pivot it began as, so that pivot's bound is close.

Rows never move: a round is a map that gives a sum per centroid and entry from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stored
from tabprep.llm.whole_vectors import ENTRIES, as_longs, computable, pack, sums, unpacked

#: Relative error that roots and their differences are allowed, far above that of doubles.
MARGIN = 1e-9


@dataclass(frozen=True)
class Centroids:
    """Centroids as rows of whole numbers, and the pivots the table was built with."""

    pivots: list[list[int]]
    rows: list[list[int]]

    def table(self, x: np.ndarray) -> np.ndarray:
        """Distances of each vector to each pivot."""
        return np.stack([_roots(_squared(x, np.array(p, x.dtype))) for p in self.pivots], axis=1) if self.pivots else np.zeros((len(x), 0))

    def nearest(self, x: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each vector's nearest centroid (the smaller number on ties), its squared distance, and how many distances were taken."""
        rows = computable(np.array(self.rows, np.int64))
        if rows.dtype == object:
            x = x.astype(object)
        rows = rows.astype(x.dtype)
        own = self.table(rows)
        least = np.zeros((len(x), len(rows)))
        for p in range(own.shape[1]):
            a, b = table[:, p, None], own[None, :, p]
            np.maximum(least, np.abs(a - b) - MARGIN * (a + b), out=least)
        least = least * least * (1 - MARGIN)
        label = least.argmin(axis=1)
        best = _squared(x, rows[label])
        taken, begun = len(x), label.copy()
        for c in range(len(rows)):
            at = np.flatnonzero((begun != c) & (least[:, c] <= best))
            taken += len(at)
            if len(at):
                d = _squared(x[at], rows[c])
                closer = at[(d < best[at]) | ((d == best[at]) & (c < label[at]))]
                best[closer], label[closer] = d[np.isin(at, closer, assume_unique=True)], c
        return label, best, taken


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def cluster(df: DataFrame, key: str, vector: str, width: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> tuple[DataFrame, Centroids]:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector, and the centroids.

    Kept are vectors of exactly ``width`` entries, none null or non-finite; an entry becomes
    floor(scale * entry). The k first centroids are the vectors with the smallest hexadecimal
    SHA-256 of ``seed:key`` (a null key is empty there; rows that tie are ordered by their integers). Each
    round deals every vector to its nearest centroid, the smaller number on ties, and moves every
    centroid that has vectors to the floor of their mean; at last the vectors are dealt once more.
    ``distance`` is squared; the inertias are its sums. Keys may be null or repeat, each row stands
    for itself. Fewer vectors than k are as many centroids; an empty table gives an empty result.
    Distances beyond 64 bits, and the sums that hold them, are null. Other columns are not read.

    The driver holds k centroids; the k first come from an ordered limit of k rows.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    entries = F.transform(F.col(vector).cast("array<double>"), lambda e: F.floor(e * scale))
    ranked = pack(df, {"rank": F.sha2(name, 256), "entries": entries}, vector, scale).filter(F.col("width") == width)
    first = ranked.orderBy("rank", "entries").limit(k).collect()
    rows = pack(df, {"key": F.col(key)}, vector, scale).filter(F.col("width") == width)
    start = unpacked(pa.array([bytes(r.x) for r in first], pa.binary()), width).tolist()
    centroids = Centroids(start, start)
    pivots = Centroids(start, [])
    kept = rows.columns.index("x")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, width):
                table = pivots.table(computable(unpacked(part.column(kept), width)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(kept), _lists(table)], names=["key", "x", "pivots"])

    kind = df.schema[key].dataType.simpleString()
    rows = stored(rows.mapInArrow(measure, f"key {kind}, x binary, pivots array<double>"), "pivots")
    for _ in range(rounds):
        centroids = _moved(rows, centroids, width)
    return _dealt(rows, centroids, width, kind).withColumnRenamed("key", key), centroids


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, ENTRIES // max(1, width))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _lists(table: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, table.size + 1, max(1, table.shape[1]), dtype=np.int32)[: len(table) + 1]), pa.array(table.ravel()))


def _table(part: pa.RecordBatch, pivots: int) -> np.ndarray:
    return part.column(part.schema.get_field_index("pivots")).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, pivots)


def _moved(rows: DataFrame, centroids: Centroids, width: int) -> Centroids:
    """The centroids at the floor of their vectors' mean; a centroid without vectors stays."""
    pivots = len(centroids.pivots)

    def parts(x: np.ndarray, part: pa.RecordBatch) -> dict[int, int]:
        out = {}
        label, _, _ = centroids.nearest(x, _table(part, pivots))
        for c in np.unique(label).tolist():
            own = x[label == c]
            out[c * (width + 1)] = len(own)
            out |= {c * (width + 1) + 1 + i: int(s) for i, s in enumerate(own.astype(object).sum(axis=0) if x.dtype == object else own.sum(axis=0))}
        return out

    total = sums(rows, width, parts)
    moved = []
    for c, old in enumerate(centroids.rows):
        at = c * (width + 1)
        moved.append([total[at + 1 + i] // total[at] for i in range(width)] if total.get(at) else old)
    return Centroids(centroids.pivots, moved)


def _dealt(rows: DataFrame, centroids: Centroids, width: int, kind: str) -> DataFrame:
    """Every vector with its centroid; stored, because the sums over it are joined back."""
    pivots = len(centroids.pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, width):
                x = computable(unpacked(part.column(1), width))
                label, distance, _ = centroids.nearest(x, _table(part, pivots))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(label, pa.int32()), as_longs(distance)], names=["key", "cluster", "distance"])

    dealt = stored(rows.mapInArrow(deal, f"key {kind}, cluster int, distance bigint"), "clusters")
    known = F.count("distance") == F.count("*")
    total = dealt.groupBy("cluster").agg(F.when(known, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("d")).collect()
    inertia = {r.cluster: None if r.d is None else int(r.d) for r in total}
    whole = None if None in inertia.values() else sum(inertia.values())

    def long(value: int | None) -> F.Column:
        return F.lit(value if value is not None and value < 1 << 63 else None).cast("bigint")

    def by_cluster(values: dict[int, F.Column]) -> F.Column:
        return F.element_at(F.array(*values.values()), F.col("cluster") + 1) if values else F.lit(None)

    marks = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in centroids.rows]
    numbers = range(len(centroids.rows))
    return dealt.select(
        "key", "cluster", "distance", by_cluster({c: long(inertia.get(c, 0)) for c in numbers}).cast("bigint").alias("cluster_inertia"),
        long(whole).alias("inertia"), by_cluster({c: F.lit(marks[c]) for c in numbers}).cast("string").alias("centroid_sha256"),
    )
