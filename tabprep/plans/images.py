"""Image table jobs: preparation and seeded views.

Tables are ``(image_id, h, w, c, pixels ARRAY<INT>, ...)``; every step is a map over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions import pixels as P
from tabprep.functions import vectors as V
from tabprep.functions.seeded import u
from tabprep.operators.profile import class_counts
from tabprep.operators.sampling import sample_per_class

SHAPE = ("h", "w", "c")


def shape():
    return [F.col(s) for s in SHAPE]


def equalize(df: DataFrame, clip: float = 6.0, rows: int = 8, cols: int = 8) -> DataFrame:
    """Contrast-limited adaptive equalisation of every channel."""
    even = P.equalize(clip, rows, cols)("pixels", *SHAPE)
    # the second use of `pixels` keeps a computed array out of the call, where Spark cannot run it
    return df.withColumn("pixels", F.when(F.col("pixels").isNotNull(), even))


def equalize_value(df: DataFrame, clip: float = 40.0, rows: int = 10, cols: int = 10) -> DataFrame:
    """The same on the brightness of three-channel images; hue and saturation stay."""
    hsv = F.transform(P.pixel_structs(F.col("pixels")), lambda p: P.rgb_to_hsv(p["r"], p["g"], p["b"]))
    split = df.withColumn("_hsv", hsv).withColumn("_v", F.transform("_hsv", lambda p: p["v"]))
    even = split.withColumn("_v", P.equalize(clip, rows, cols)("_v", "h", "w", F.lit(1)))
    rgb = F.zip_with("_hsv", "_v", lambda p, v: P.hsv_to_rgb(p["h"], p["s"], v))
    flat = F.flatten(F.transform(rgb, lambda p: F.array(p["r"], p["g"], p["b"])))
    return even.withColumn("pixels", flat).drop("_hsv", "_v")


def resize(df: DataFrame, to_h: int, to_w: int) -> DataFrame:
    new = P.resize_nearest(F.col("pixels"), *shape(), F.lit(to_h), F.lit(to_w))
    # one after the other: inside a lambda, `withColumns` would read the new height and width
    return df.withColumn("pixels", new).withColumns({"h": F.lit(to_h), "w": F.lit(to_w)})


def image_prepare(
    df: DataFrame,
    size: tuple[int, int],
    mean: Sequence[float],
    std: Sequence[float],
    label: str | None = "label",
    clip: float = 40.0,
    tiles: tuple[int, int] = (10, 10),
) -> DataFrame:
    """``(image_id, label, values ARRAY<DOUBLE>)`` ready for training.

    Equalise brightness (every channel of other images), resize, scale to [0, 1],
    standardise per channel, channels first.
    """
    channels = len(mean)
    even = equalize_value(df, clip, *tiles) if channels == 3 else equalize(df, clip, *tiles)
    sized = resize(even, *size)
    unit = sized.withColumn("_unit", V.rescale(F.col("pixels"), 1 / 255, 0.0))
    scaled = unit.withColumn("_std", V.standardize(F.col("_unit"), mean, std))
    values = P.hwc_to_chw(F.col("_std"), F.lit(size[0]), F.lit(size[1]), F.lit(channels))
    kept = [F.col(label).cast("int").alias("label")] if label else []
    return scaled.select("image_id", *kept, values.alias("values"))


def image_views(df: DataFrame, views: int, seed: int) -> DataFrame:
    """``(image_id, view, pixels)``: view 0 is the image, the others are flipped by chance, and jittered in brightness and contrast."""
    many = df.withColumn("view", F.explode(F.sequence(F.lit(0), F.lit(views - 1))))

    def draw(step: str):
        return u(seed, F.col("image_id"), F.col("view"), step)

    def gated(df: DataFrame, step: str, p: float, changed) -> DataFrame:
        picked = P.with_probability(draw(step), p, changed, F.col("pixels"))
        return df.withColumn("pixels", F.when(F.col("view") == 0, F.col("pixels")).otherwise(picked))

    many = gated(many, "flip_h", 0.5, P.flip_h(F.col("pixels"), *shape()))
    many = gated(many, "flip_v", 0.5, P.flip_v(F.col("pixels"), *shape()))
    many = many.withColumn("_f", 0.8 + 0.4 * draw("brightness"))
    many = gated(many, "always", 1.0, P.brightness(F.col("pixels"), F.col("_f")))
    many = many.withColumn("_f", 0.8 + 0.4 * draw("contrast"))
    many = gated(many, "always", 1.0, P.contrast(F.col("pixels"), F.col("_f")))
    return many.select("image_id", "view", "pixels")


def class_image_sample(
    df: DataFrame, key: str, label: str, n: int, seed: int, columns: Sequence[str]
) -> DataFrame:
    """``n`` images of the largest and of the smallest class."""
    counts = class_counts(df, label)
    ends = counts.agg(
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("a"),
        F.min_by(label, F.struct(F.col("n"), F.col(label))).alias("b"),
    ).first()
    chosen = df.filter(F.col(label).isin(ends["a"], ends["b"]))
    return sample_per_class(chosen, key, label, n, seed, "class").select(key, label, *columns)
