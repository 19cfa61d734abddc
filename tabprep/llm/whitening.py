"""Whitening of vectors with an exact covariance, by polarisation.

For centred values a and b, 2 cov(a, b) = var(a + b) - var(a) - var(b). So the whole covariance follows from
sums of squares alone: of every dimension, and of the sum of every two dimensions. All
are whole numbers and exact: values are centred on the whole part of their mean before
they are squared, and the rest of the mean, a fraction with the number of vectors below the line,
is taken out of the total. Only the eigenvectors are floating-point work, on a d x d matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stored
from tabprep.llm.whole_vectors import ENTRIES, computable, pack, sums, unpacked

#: Dimensions at most: the driver holds a number for every two of them.
MOST_DIMENSIONS = 2048


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` distinct vectors, their sums, eigenvalues (falling) and eigenvectors (columns)."""

    width: int
    n: int
    total: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def whole(self) -> list[int]:
        """The whole part of each dimension's mean."""
        return [s // self.n for s in self.total]

    @property
    def rest(self) -> list[int]:
        """What the whole parts leave of the sums: below n in every dimension."""
        return [s % self.n for s in self.total]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array(self.whole, x.dtype if x.dtype == object else np.int64)

    def whitened(self, y: np.ndarray, components: int) -> np.ndarray:
        """Components of vectors centred on the whole parts; nan where a component has no variance."""
        z = y.astype(np.float64) - np.array([r / self.n for r in self.rest])
        e = self.values[:components]
        scale = np.array([1 / np.sqrt(v) if v > self.negligible else np.nan for v in e])
        return (z @ self.vectors[:, :components]) * scale

    @property
    def negligible(self) -> float:
        """Eigenvalues up to this are zero but for rounding."""
        return self.trace * self.width * 2.0**-50

    def deviation(self, y: np.ndarray) -> list[int]:
        """For each vector the sum over dimensions of (n * x - S) squared, exact."""
        rest = np.array(self.rest, object)
        square = (y * y).sum(axis=1).astype(object)
        small = y.dtype != object and self.n * self.width < 1 << 34
        cross = (y @ rest.astype(np.int64)).astype(object) if small else y.astype(object) @ rest
        return list(self.n * self.n * square - 2 * self.n * cross + int((rest * rest).sum()))


def fit(df: DataFrame, vector: str, scale: int = 256) -> tuple[Whitening | None, DataFrame]:
    """The transform fitted on each distinct rounded vector once, and the list it was fitted on.

    None if there are no vectors. Of vectors of several lengths those of the length that most
    distinct vectors have (the shorter on ties) are the fit list. Copies meet before they are
    shuffled and never count twice, however many there are.
    """
    distinct = stored(pack(df, {}, vector, scale).distinct(), "distinct")
    found = distinct.groupBy("width").count().filter("width > 0").orderBy(F.desc("count"), "width").first()
    if found is None:
        return None, distinct
    width, n = found["width"], found["count"]
    if width > MOST_DIMENSIONS:
        raise ValueError(f"{width} dimensions; the covariance is built for at most {MOST_DIMENSIONS}")
    listed = distinct.filter(F.col("width") == width).select("x")
    got = sums(listed, width, lambda x, _: dict(enumerate(int(s) for s in x.sum(axis=0))))
    total = [got[i] for i in range(width)]
    squares = sums(listed, width, _squares([s // n for s in total]))
    covariance = _covariance(squares, [s % n for s in total], n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1].copy(), vectors[:, ::-1].copy()
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)] < 0, -1.0, 1.0)
    return Whitening(width, n, tuple(total), values, vectors, float(np.trace(covariance))), listed


def _squares(whole: list[int]):
    """Sums of squares of each dimension (number i * d + i) and of the sum of every two (i * d + j)."""
    d = len(whole)

    def parts(x: np.ndarray, _: pa.RecordBatch) -> dict[int, int]:
        y = computable(x - np.array(whole, object if x.dtype == object else np.int64))
        out = {}
        for i in range(d):
            own = (y[:, i] * y[:, i]).sum()
            out[i * d + i] = int(own)
            pair = y[:, i : i + 1] + y[:, i + 1 :]
            for j, s in enumerate((pair * pair).sum(axis=0), i + 1):
                out[i * d + j] = int(s)
        return out

    return parts


def _covariance(squares: dict[int, int], rest: list[int], n: int) -> np.ndarray:
    """Covariances with divisor n, each rounded once.

    For values y with sum r, n**2 times the sum of squares of y - r / n is n * (n * sum(y * y) - r * r).
    """
    d = len(rest)

    def spread(i: int, j: int) -> int:
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i * d + j] - r * r

    out = np.empty((d, d))
    own = [spread(i, i) for i in range(d)]
    for i in range(d):
        out[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = float(Fraction(spread(i, j) - own[i] - own[j], 2 * n * n))
    return out


def identity_error(model: Whitening, listed: DataFrame, components: int) -> float | None:
    """How far the covariance of the whitened fit list is from the identity, at most in any entry.

    Measured on the vectors, not derived from the matrix. Components without variance are left out.
    None if none has any.
    """
    k = int((model.values[:components] > model.negligible).sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            step = max(1, ENTRIES // model.width)
            for start in range(0, batch.num_rows, step):
                x = computable(unpacked(batch.column(0).slice(start, step), model.width))
                w = np.column_stack([model.whitened(model.centred(x), k), np.ones(len(x))])
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["number", "value"])

    found = listed.select("x").mapInArrow(run, "number bigint, value double").groupBy("number").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros(len(found))
    for r in found:
        moments[r.number] = r.value
    moments = moments.reshape(k + 1, k + 1) / model.n
    mean = moments[k, :k]
    return float(np.abs(moments[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, key: str, vector: str, components: int = 4, scale: int = 256) -> tuple[DataFrame, Whitening | None]:
    """``key, component, n, deviation, whitened, explained, identity_error`` per vector and component, and the model.

    An entry becomes floor(scale * entry); vectors that are null or hold null or non-finite entries
    go, and so do vectors of another length than the fit list's (see ``fit``). Components
    are numbered from 1 by falling eigenvalue; there are as many as dimensions at most. ``deviation``
    is decimal(38,0), null where it has more digits; ``explained`` is the eigenvalue's part of the trace.
    A component without variance (all vectors equal, or on a plane) has null ``whitened``, and
    ``explained`` is null where nothing varies; ``identity_error`` is over the others. Keys may be
    null or repeat, each row stands for itself; an empty table gives an empty result. Other columns are not read.

    Only distinct vectors are shuffled. Rows are whitened by a map where they are read.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model, listed = fit(df, vector, scale)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key), None
    error = identity_error(model, listed, components)
    k = min(components, model.width)
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values[:k]]
    rows = pack(df, {"key": F.col(key)}, vector, scale).filter(F.col("width") == model.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = pa.decimal128(38, 0)
        for batch in batches:
            step = max(1, ENTRIES // max(model.width, 16 * k))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                m = part.num_rows
                y = computable(model.centred(computable(unpacked(part.column(2), model.width))))
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in model.deviation(y)], decimal)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        deviation.take(pa.array(each)), pa.array(model.whitened(y, k).ravel(), from_pandas=True), pa.array(explained * m, pa.float64()),
                        pa.array([error] * (m * k), pa.float64()),
                    ],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key), model
