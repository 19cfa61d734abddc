"""Column functions on interleaved pixel arrays (row by row, channels of a pixel together).

Geometry is an index map: output position -> input position, one ``get`` per value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.vectors import let


def _remap(pixels: Column, size: Column, source) -> Column:
    # `let`: an array built by an earlier step is evaluated once, not once per pixel
    at = F.sequence(F.lit(0), size - 1)
    return let(pixels, lambda p: F.transform(at, lambda i: F.get(p, source(i).cast("int"))))


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("int")


def resize_nearest(pixels: Column, h: Column, w: Column, c: Column, to_h: Column, to_w: Column) -> Column:
    """Nearest neighbour: source row = floor(y * h / to_h), column likewise."""

    def source(i: Column) -> Column:
        y, x = _div(_div(i, c), to_w), _div(i, c) % to_w
        return (_div(y * h, to_h) * w + _div(x * w, to_w)) * c + i % c

    return _remap(pixels, to_h * to_w * c, source)


def short_side(h: Column, w: Column, size: int) -> tuple[Column, Column]:
    """Height and width after scaling the shorter side to ``size``."""
    return (
        F.when(h <= w, F.lit(size)).otherwise(_div(h * size, w)),
        F.when(w <= h, F.lit(size)).otherwise(_div(w * size, h)),
    )


def flip_h(pixels: Column, h: Column, w: Column, c: Column) -> Column:
    def source(i: Column) -> Column:
        x = _div(i, c) % w
        return i + (w - 1 - 2 * x) * c

    return _remap(pixels, h * w * c, source)


def flip_v(pixels: Column, h: Column, w: Column, c: Column) -> Column:
    def source(i: Column) -> Column:
        y = _div(i, w * c)
        return i + (h - 1 - 2 * y) * w * c

    return _remap(pixels, h * w * c, source)


def hwc_to_chw(pixels: Column, h: Column, w: Column, c: Column) -> Column:
    return _remap(pixels, h * w * c, lambda i: (i % (h * w)) * c + _div(i, h * w))


def chw_to_hwc(pixels: Column, h: Column, w: Column, c: Column) -> Column:
    return _remap(pixels, h * w * c, lambda i: (i % c) * h * w + _div(i, c))


def _clip(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0)), F.lit(255)).cast("int")


def brightness(pixels: Column, factor: Column) -> Column:
    """Multiply by a factor, clip to [0, 255]."""
    return F.transform(pixels, lambda x: _clip(F.floor(x * factor)))


def contrast(pixels: Column, factor: Column) -> Column:
    """Stretch around the mean by a factor, clip to [0, 255]."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda a, x: a + x) / F.size(pixels)
    about = F.array_repeat(mean, F.size(pixels))
    return F.zip_with(pixels, about, lambda x, m: _clip(F.floor(m + (x - m) * factor)))


def with_probability(draw: Column, p: float, changed: Column, plain: Column) -> Column:
    """The changed value where the draw falls under ``p``."""
    return F.when(draw < p, changed).otherwise(plain)


def _half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("int")


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """8-bit ``STRUCT<h, s, v>``: hue in half degrees 0..179, saturation and value 0..255."""
    v, low = F.greatest(r, g, b), F.least(r, g, b)
    span = v - low
    turn = (
        F.when(span == 0, F.lit(0.0))
        .when(v == r, 60.0 * (g - b) / span)
        .when(v == g, 120.0 + 60.0 * (b - r) / span)
        .otherwise(240.0 + 60.0 * (r - g) / span)
    )
    hue = _half_up(F.when(turn < 0, turn + 360).otherwise(turn) / 2) % 180
    sat = F.when(v == 0, F.lit(0)).otherwise(_half_up(255.0 * span / v))
    return F.struct(hue.alias("h"), sat.alias("s"), v.cast("int").alias("v"))


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """Inverse of :func:`rgb_to_hsv`, ``STRUCT<r, g, b>``."""
    sector = h / 30.0
    part = sector - F.floor(sector)
    k = F.floor(sector).cast("int")
    sat = s / 255.0
    p, q, t = v * (1 - sat), v * (1 - sat * part), v * (1 - sat * (1 - part))

    def channel(*by_sector: Column) -> Column:
        return _half_up(F.get(F.array(*[x.cast("double") for x in by_sector]), k))

    return F.struct(
        channel(v, q, p, p, t, v).alias("r"),
        channel(t, v, v, q, p, p).alias("g"),
        channel(p, p, t, v, v, q).alias("b"),
    )


def pixel_structs(pixels: Column) -> Column:
    """Three-channel pixels as ``ARRAY<STRUCT<r, g, b>>``."""

    def triples(p: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(p) - 3, F.lit(3))
        channel = [(0, "r"), (1, "g"), (2, "b")]
        return F.transform(starts, lambda i: F.struct(*[F.get(p, i + k).alias(name) for k, name in channel]))

    return let(pixels, triples)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def bytes_to_pixels(data: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unsigned bytes as integers."""
    for batch in data:
        yield batch.map(lambda b: None if b is None else np.frombuffer(b, np.uint8).astype(np.int32))


def _tile_tables(plane: np.ndarray, clip: float, rows: int, cols: int) -> np.ndarray:
    """Per tile the lookup table of 256 equalised values; ``plane`` divides evenly into tiles."""
    th, tw = plane.shape[0] // rows, plane.shape[1] // cols
    area = th * tw
    tiles = plane.reshape(rows, th, cols, tw).swapaxes(1, 2).reshape(rows * cols, area)
    offset = tiles.astype(np.int64) + 256 * np.arange(rows * cols)[:, None]
    hist = np.bincount(offset.ravel(), minlength=256 * rows * cols).reshape(-1, 256)
    limit = max(1, int(clip * area / 256))
    excess = np.maximum(hist - limit, 0).sum(axis=1)
    hist = np.minimum(hist, limit) + (excess // 256)[:, None]
    for t, left in enumerate(excess % 256):  # the remainder, one each at a fixed step
        if left:
            hist[t, np.arange(left) * max(256 // left, 1)] += 1
    return np.rint(np.cumsum(hist, axis=1) * (255.0 / area)).clip(0, 255).reshape(rows, cols, 256)


def _equalize_plane(plane: np.ndarray, clip: float, rows: int, cols: int) -> np.ndarray:
    """Contrast-limited adaptive equalisation of one channel (Zuiderveld 1994)."""
    h, w = plane.shape
    pad = ((0, (rows - h % rows) if h % rows or w % cols else 0), (0, (cols - w % cols) if h % rows or w % cols else 0))
    padded = np.pad(plane, pad, mode="reflect") if any(map(any, pad)) else plane
    tables = _tile_tables(padded, clip, rows, cols)

    def neighbours(n: int, size: int, tiles: int):
        at = np.arange(n) / size - 0.5
        low = np.floor(at).astype(int)
        return np.maximum(low, 0), np.minimum(low + 1, tiles - 1), at - low

    y0, y1, fy = neighbours(h, padded.shape[0] // rows, rows)
    x0, x1, fx = neighbours(w, padded.shape[1] // cols, cols)
    top = tables[y0[:, None], x0, plane] * (1 - fx) + tables[y0[:, None], x1, plane] * fx
    low = tables[y1[:, None], x0, plane] * (1 - fx) + tables[y1[:, None], x1, plane] * fx
    return np.rint(top * (1 - fy)[:, None] + low * fy[:, None]).clip(0, 255).astype(np.int32)


def equalize(clip: float, rows: int, cols: int):
    """``f(pixels, h, w, c) -> pixels``: adaptive equalisation of every channel.

    One image is one row, so the work is a map over Arrow batches and needs no shuffle; a
    pixel table would move every pixel three times.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def apply(pixels: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        def one(p, h, w, c):
            image = np.asarray(p, dtype=np.int32).reshape(h, w, c)
            planes = [_equalize_plane(image[:, :, k], clip, rows, cols) for k in range(c)]
            return np.stack(planes, axis=2).ravel()

        return pd.Series([None if p is None else one(p, *shape) for p, *shape in zip(pixels, h, w, c)])

    return apply
