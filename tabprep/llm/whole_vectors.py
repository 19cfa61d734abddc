"""Vectors of whole numbers, and their exact sums.

A vector's entries are scaled, rounded down and packed into one binary value: little-endian
integers of 2, 4 or 8 bytes, the least width that holds the vector, so equal vectors are equal
values. Sums leave a task as two decimals, the parts above and below 2**64, and so hold whatever
the entries are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of vectors that a task works on at once.
ENTRIES = 1 << 19
#: Squares of sums or differences of two entries below this, as many as ``ENTRIES``, add up to less than 2**62.
SMALL = 1 << 20

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def rounded(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length of vector: places of the vectors in the column, and floor(scale * entry) as a matrix.

    Vectors that are null or hold null or non-finite entries are left out. A number that 64 bits
    do not hold is the nearest that they hold.
    """
    at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    width = pc.list_value_length(column).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(width)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = bad[ends] == bad[ends - width]
    for w in np.unique(width[good]).tolist():
        own = np.flatnonzero(good & (width == w))
        with np.errstate(over="ignore"):
            x = np.floor(values[(ends[own] - w)[:, None] + np.arange(w)] * float(scale))
        out = np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)
        far = np.abs(x) >= 2.0**62
        if far.any():
            out[far] = [max(_LEAST, min(_MOST, int(v))) if np.isfinite(v) else (_MOST if v > 0 else _LEAST) for v in x[far]]
        yield at[own], out


def packed(x: np.ndarray) -> list[bytes]:
    """Each row of a matrix of integers as one binary value."""
    most = np.maximum(x.max(axis=1), ~x.min(axis=1)) if x.shape[1] else np.zeros(len(x), np.int64)
    out = np.empty(len(x), object)
    for kind, least, limit in (("<i2", -1, 1 << 15), ("<i4", (1 << 15) - 1, 1 << 31), ("<i8", (1 << 31) - 1, 1 << 63)):
        own = np.flatnonzero((most > least) & (most < limit) if limit < 1 << 63 else most > least)
        if len(own):
            wide = x[own].astype(kind)
            raw, step = wide.tobytes(), wide.itemsize * x.shape[1]
            out[own] = [raw[i * step : (i + 1) * step] for i in range(len(own))]
    return out.tolist()


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """The matrix of some packed vectors of ``width`` entries each."""
    x = np.zeros((len(column), width), np.int64)
    if not width:
        return x
    values = column.to_pylist()
    size = np.array([len(v) // width for v in values])
    for s in np.unique(size).tolist():
        own = np.flatnonzero(size == s)
        x[own] = np.frombuffer(b"".join(values[i] for i in own.tolist()), f"<i{s}").reshape(len(own), width)
    return x


def pack(df: DataFrame, keep: dict[str, F.Column], vector: str, scale: int) -> DataFrame:
    """The columns ``keep`` of the rows that have a vector, with ``width`` and the packed vector ``x``.

    A map over Arrow batches; see ``rounded`` for the rows that go.
    """
    rows = df.select(*[c.alias(name) for name, c in keep.items()], F.col(vector).cast("array<double>").alias("x"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, len(kept)):
                for at, x in rounded(part.column(len(kept)), scale):
                    rows = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns[:-1], pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(packed(x), pa.binary())], names=[*kept, "width", "x"]
                    )

    own = "".join(f"`{name}` {rows.schema[name].dataType.simpleString()}, " for name in kept)
    return rows.mapInArrow(run, f"{own}width int, x binary")


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of a bounded number of entries, or of one vector."""
    width = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(width.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + ENTRIES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def computable(x: np.ndarray) -> np.ndarray:
    """The matrix as 64-bit integers, or as Python's if squares of its entries could be too large to add up."""
    return x if not x.size or max(int(x.max()), -int(x.min())) < SMALL else x.astype(object)


def sums(rows: DataFrame, width: int, parts: Callable[[np.ndarray, pa.RecordBatch], dict[int, int]]) -> dict[int, int]:
    """Exact totals by a small number, of what ``parts`` gives for each slice of packed vectors (column ``x``).

    A task adds up its slices and gives one row per number; those are added by Spark. The caller
    bounds how many numbers there are; that many rows come to the driver.
    """
    place = rows.columns.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            step = max(1, ENTRIES // max(1, width))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                for number, value in parts(computable(unpacked(part.column(place), width)), part).items():
                    total[number] = total.get(number, 0) + value
        high = [Decimal(v >> 64) for v in total.values()]
        low = [Decimal(v & (1 << 64) - 1) for v in total.values()]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(high, kind), pa.array(low, kind)], names=["number", "high", "low"])

    found = rows.mapInArrow(run, "number bigint, high decimal(38,0), low decimal(38,0)").groupBy("number").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {r.number: (int(r.high) << 64) + int(r.low) for r in found.collect()}


def as_longs(values: np.ndarray) -> pa.Array:
    """Integers of any size as a column; those beyond 64 bits are null."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if _LEAST <= v <= _MOST else None for v in values], pa.int64())
