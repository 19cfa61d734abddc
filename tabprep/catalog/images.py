"""Image tables (2.10) and image scans (2.1).

Pixels are the embeddings scaled to bytes: 8 x 8 with one channel, or three channels taken
from the positions i, i + 21 and i + 42 (mod 64). Image files are written from them.
"""

import struct
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.catalog.vectors import MEAN, STD
from tabprep.functions import pixels as P
from tabprep.functions import vectors as V
from tabprep.functions.arrays import elements
from tabprep.functions.seeded import u
from tabprep.operators import profile
from tabprep.operators.sampling import sample_n
from tabprep.plans import images as jobs
from tabprep.session import address, scratch_path, stored
from tabprep.sources import images as scans


def gray(t: Tables):
    """``(image_id, label, h, w, c, pixels)``, 8 x 8 x 1."""

    def scale(v):
        ends = F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi"))
        return V.let(ends, lambda e: F.transform(v, lambda x: F.floor(255 * (x - e["lo"]) / (e["hi"] - e["lo"])).cast("int")))

    scaled = V.let(F.col("embedding").cast("array<double>"), scale)
    return t.spread("embeddings", "vec_id").select(
        F.col("vec_id").alias("image_id"), "label", F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(1).alias("c"),
        scaled.alias("pixels"),
    )


def color(t: Tables):
    """``(image_id, label, h, w, c, pixels)``, 8 x 8 x 3."""
    at = F.sequence(F.lit(0), F.lit(191))

    def channels(p):
        return F.transform(at, lambda i: F.get(p, ((F.floor(i / 3) + 21 * (i % 3)) % 64).cast("int")))

    return gray(t).withColumns({"pixels": V.let(F.col("pixels"), channels), "c": F.lit(3)})


_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
GRAY = f"""gray AS (SELECT vec_id AS image_id, label, pos, CAST(floor(255 * (x - lo) / (hi - lo)) AS INTEGER) AS px FROM
  (SELECT vec_id, label, list_min(v) AS lo, list_max(v) AS hi, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM {_E}))"""
COLOR = """color AS (SELECT image_id, label, pos * 3 + ch AS pos, px FROM (SELECT image_id, label, px, ch,
  (pos + 64 - 21 * ch) % 64 AS pos FROM gray, (SELECT unnest(range(3)) AS ch)))"""
_OUT = "image_id, CAST({} AS INTEGER) AS pos, CAST(px AS INTEGER) AS px"


def _long(df, array="pixels", keep=("image_id",)):
    return elements(df, keep, array, "px", "pos")



@query("resize_nearest", with_(GRAY, COLOR) + """SELECT g.image_id, CAST((y * 5 + x) * 3 + ch AS INTEGER) AS pos, px
  FROM (SELECT unnest(range(6)) AS y) a, (SELECT unnest(range(5)) AS x) b, (SELECT unnest(range(3)) AS ch) c
  JOIN color g ON g.pos = (((y * 8) // 6) * 8 + ((x * 8) // 5)) * 3 + ch""")
def resize_nearest(t: Tables):
    return _long(jobs.resize(color(t), 6, 5))


@query("flip_h", with_(GRAY, COLOR) + f"SELECT {_OUT.format('((pos // 24) * 8 + 7 - (pos // 3) % 8) * 3 + pos % 3')} FROM color")
def flip_h(t: Tables):
    return _long(color(t).withColumn("pixels", P.flip_h(F.col("pixels"), *jobs.shape())))


@query("flip_v", with_(GRAY, COLOR) + f"SELECT {_OUT.format('(7 - pos // 24) * 24 + pos % 24')} FROM color")
def flip_v(t: Tables):
    return _long(color(t).withColumn("pixels", P.flip_v(F.col("pixels"), *jobs.shape())))


@query("hwc_to_chw", with_(GRAY, COLOR) + f"SELECT {_OUT.format('(pos % 3) * 64 + pos // 3')} FROM color")
def hwc_to_chw(t: Tables):
    return _long(color(t).withColumn("pixels", P.hwc_to_chw(F.col("pixels"), *jobs.shape())))


@query("chw_to_hwc", with_(GRAY, COLOR) + "SELECT image_id, CAST(pos AS INTEGER) AS pos, px FROM color")
def chw_to_hwc(t: Tables):
    there = color(t).withColumn("_chw", P.hwc_to_chw(F.col("pixels"), *jobs.shape()))
    return _long(there.withColumn("pixels", P.chw_to_hwc(F.col("_chw"), *jobs.shape())))


_BRIGHT = f"(0.8 + 0.4 * {u_sql(42, 'image_id', repr('bright'))})"


@query("brightness_jitter", with_(GRAY) + f"""SELECT image_id, CAST(pos AS INTEGER) AS pos,
  CAST(least(greatest(floor(px * {_BRIGHT}), 0), 255) AS INTEGER) AS px FROM gray""")
def brightness_jitter(t: Tables):
    factor = gray(t).withColumn("_f", 0.8 + 0.4 * u(42, F.col("image_id"), "bright"))
    return _long(factor.withColumn("pixels", P.brightness(F.col("pixels"), F.col("_f"))))


@query("contrast_jitter", with_(GRAY, "m AS (SELECT image_id, avg(px) AS mean FROM gray GROUP BY ALL)") + f"""
  SELECT image_id, CAST(pos AS INTEGER) AS pos,
  CAST(least(greatest(floor(mean + (px - mean) * {_BRIGHT}), 0), 255) AS INTEGER) AS px FROM gray JOIN m USING (image_id)""")
def contrast_jitter(t: Tables):
    factor = gray(t).withColumn("_f", 0.8 + 0.4 * u(42, F.col("image_id"), "bright"))
    return _long(factor.withColumn("pixels", P.contrast(F.col("pixels"), F.col("_f"))))


@query("apply_with_probability", with_(GRAY) + f"""SELECT image_id, CAST(CASE WHEN {u_sql(42, 'image_id', repr('gate'))} < 0.2
  THEN (7 - pos // 8) * 8 + pos % 8 ELSE pos END AS INTEGER) AS pos, px FROM gray""")
def apply_with_probability(t: Tables):
    flipped = P.flip_v(F.col("pixels"), *jobs.shape())
    picked = P.with_probability(u(42, F.col("image_id"), "gate"), 0.2, flipped, F.col("pixels"))
    return _long(gray(t).withColumn("pixels", picked))


_RGB = """rgb AS (SELECT image_id, pos // 3 AS pos, max(px) FILTER (pos % 3 = 0) AS r, max(px) FILTER (pos % 3 = 1) AS g,
  max(px) FILTER (pos % 3 = 2) AS b FROM color GROUP BY ALL),
hv AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM rgb),
turned AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN v = r THEN CAST(60.0 AS DOUBLE) * (g - b) / d
  WHEN v = g THEN 120 + CAST(60.0 AS DOUBLE) * (b - r) / d ELSE 240 + CAST(60.0 AS DOUBLE) * (r - g) / d END AS turn FROM hv),
hsv AS (SELECT image_id, pos, v, CAST(floor((CASE WHEN turn < 0 THEN turn + 360 ELSE turn END) / 2 + 0.5) AS INTEGER) % 180 AS h,
  CASE WHEN v = 0 THEN 0 ELSE CAST(floor(CAST(255.0 AS DOUBLE) * d / v + 0.5) AS INTEGER) END AS s FROM turned)"""
_BACK = """sect AS (SELECT *, CAST(floor(h / 30) AS INTEGER) AS k, h / 30 - floor(h / 30) AS f, s / 255 AS sat FROM {src}),
pqt AS (SELECT *, v * (1 - sat) AS p, v * (1 - sat * f) AS q, v * (1 - sat * (1 - f)) AS t FROM sect),
back AS (SELECT image_id, pos, CAST(floor([v, q, p, p, t, v][k + 1] + 0.5) AS INTEGER) AS r,
  CAST(floor([t, v, v, q, p, p][k + 1] + 0.5) AS INTEGER) AS g, CAST(floor([p, p, t, v, v, q][k + 1] + 0.5) AS INTEGER) AS b, h, s, v FROM pqt)"""


@query("rgb_hsv", with_(GRAY, COLOR, _RGB, _BACK.format(src="hsv")) + "SELECT image_id, CAST(pos AS INTEGER) AS pos, h, s, v, r, g, b FROM back")
def rgb_hsv(t: Tables):
    long = elements(color(t), ["image_id"], P.pixel_structs(F.col("pixels")), "p", "pos")
    hsv = long.withColumn("q", P.rgb_to_hsv(F.col("p.r"), F.col("p.g"), F.col("p.b")))
    back = hsv.withColumn("b", P.hsv_to_rgb(F.col("q.h"), F.col("q.s"), F.col("q.v")))
    return back.select("image_id", "pos", "q.*", "b.*")


@query("channel_histogram", with_(GRAY, COLOR, f"""picked AS (SELECT vec_id AS image_id FROM embeddings
  ORDER BY {u_sql(42, 'vec_id', repr('sample'))}, vec_id LIMIT 50)""") + """
  SELECT CAST(pos % 3 AS INTEGER) AS channel, px AS value, count(*) AS n FROM color JOIN picked USING (image_id) GROUP BY ALL""")
def channel_histogram(t: Tables):
    """Over the sample of 50 images that the operator is defined on."""
    return profile.channel_counts(sample_n(color(t), "image_id", 50, 42), F.col("pixels"), 3)


def _equalize_sql(src: str, clip: float, out: str) -> str:
    """Adaptive equalisation with 2 x 2 tiles of 4 x 4 pixels; ``src(image_id, ch, y, x, px)``.

    The tables of an image's four tiles are one list, which a pixel indexes.
    """
    limit = max(1, int(clip * 16 / 256))
    return f"""hist AS (SELECT image_id, ch, y // 4 AS ty, x // 4 AS tx, px, count(*) AS n FROM {src} GROUP BY ALL),
    exc AS (SELECT image_id, ch, ty, tx, CAST(sum(greatest(n - {limit}, 0)) AS BIGINT) AS e FROM hist GROUP BY ALL),
    clipped AS (SELECT e.*, val, least(coalesce(n, 0), {limit}) + (e // 256)
      + CASE WHEN e % 256 > 0 AND val % greatest((256 // (e % 256)), 1) = 0 AND (val // greatest((256 // (e % 256)), 1)) < e % 256 THEN 1 ELSE 0 END AS n
      FROM exc e CROSS JOIN (SELECT unnest(range(256)) AS val) LEFT JOIN hist h
      ON h.image_id = e.image_id AND h.ch = e.ch AND h.ty = e.ty AND h.tx = e.tx AND h.px = val),
    lut AS (SELECT image_id, ch, ty, tx, val, least(round_even(CAST(sum(n) OVER (PARTITION BY image_id, ch, ty, tx ORDER BY val) AS DOUBLE) * (CAST(255 AS DOUBLE) / 16), 0), 255) AS m FROM clipped),
    luts AS (SELECT image_id, ch, list(m ORDER BY ty, tx, val) AS q FROM lut GROUP BY image_id, ch),
    near AS (SELECT image_id, ch, y, x, px, greatest(floor(y / 4 - 0.5), 0) AS y0, least(floor(y / 4 - 0.5) + 1, 1) AS y1, y / 4 - 0.5 - floor(y / 4 - 0.5) AS fy,
      greatest(floor(x / 4 - 0.5), 0) AS x0, least(floor(x / 4 - 0.5) + 1, 1) AS x1, x / 4 - 0.5 - floor(x / 4 - 0.5) AS fx FROM {src}),
    {out} AS (SELECT image_id, ch, y, x, CAST(round_even((a * (1 - fx) + b * fx) * (1 - fy) + (c * (1 - fx) + d * fx) * fy, 0) AS INTEGER) AS px FROM
      (SELECT near.*, {', '.join(f"q[CAST(({ty} * 2 + {tx}) * 256 + px + 1 AS INTEGER)] AS {n}"
                                 for n, ty, tx in (('a', 'y0', 'x0'), ('b', 'y0', 'x1'), ('c', 'y1', 'x0'), ('d', 'y1', 'x1')))}
       FROM near JOIN luts USING (image_id, ch)))"""


_PLANES = "planes AS (SELECT image_id, pos % 3 AS ch, pos // 24 AS y, (pos // 3) % 8 AS x, px FROM color)"


@query("clahe_gray", with_(GRAY, COLOR, _PLANES, _equalize_sql("planes", 40, "eq")) + """
  SELECT image_id, CAST((y * 8 + x) * 3 + ch AS INTEGER) AS pos, px FROM eq""")
def clahe_gray(t: Tables):
    return _long(jobs.equalize(color(t), 40, 2, 2))


_EVEN = with_(GRAY, COLOR, _RGB, "vp AS (SELECT image_id, 0 AS ch, pos // 8 AS y, pos % 8 AS x, v AS px FROM hsv)",
              _equalize_sql("vp", 40, "eq"),
              "even AS (SELECT hsv.image_id, pos, h, s, eq.px AS v FROM hsv JOIN eq ON eq.image_id = hsv.image_id AND pos = y * 8 + x)",
              _BACK.format(src="even"))


@query("clahe_value", _EVEN + """
  SELECT image_id, CAST(pos * 3 + ch AS INTEGER) AS pos, [r, g, b][ch + 1] AS px FROM back, (SELECT unnest(range(3)) AS ch)""")
def clahe_value(t: Tables):
    return _long(jobs.equalize_value(color(t), 40, 2, 2))


@query("image_prepare", _EVEN + f"""
  SELECT image_id, CAST(label AS INTEGER) AS label, CAST(ch * 144 + y * 12 + x AS INTEGER) AS pos,
    round(([r, g, b][ch + 1] / 255.0 - {list(MEAN)}[ch + 1]) / {list(STD)}[ch + 1], 6) AS value
  FROM back JOIN embeddings ON image_id = vec_id, (SELECT unnest(range(12)) AS y) a, (SELECT unnest(range(12)) AS x) b,
    (SELECT unnest(range(3)) AS ch) c WHERE pos = ((y * 8) // 12) * 8 + (x * 8) // 12""")
def image_prepare(t: Tables):
    path = scratch_path(t.spark, "prepared.parquet")
    jobs.image_prepare(color(t), (12, 12), MEAN, STD, tiles=(2, 2)).write.parquet(path)
    rows = elements(t.spark.read.parquet(path), ["image_id", "label"], "values", "value", "pos")
    return rows.withColumn("value", F.round("value", 6))


_VIEW = f"""v0 AS (SELECT image_id, view, pos, px FROM color, (SELECT unnest(range(4)) AS view)),
v1 AS (SELECT image_id, view, px, CASE WHEN view > 0 AND {u_sql(42, 'image_id', 'view', repr('flip_h'))} < 0.5
  THEN ((pos // 24) * 8 + 7 - (pos // 3) % 8) * 3 + pos % 3 ELSE pos END AS pos FROM v0),
v2 AS (SELECT image_id, view, px, CASE WHEN view > 0 AND {u_sql(42, 'image_id', 'view', repr('flip_v'))} < 0.5
  THEN (7 - pos // 24) * 24 + pos % 24 ELSE pos END AS pos FROM v1)"""


@query("image_views", with_(GRAY, COLOR, _VIEW, f"""v3 AS (SELECT image_id, view, pos,
  CASE WHEN view = 0 THEN px ELSE least(greatest(floor(px * (0.8 + 0.4 * {u_sql(42, 'image_id', 'view', repr('brightness'))})), 0), 255) END AS px FROM v2)""",
  "v4 AS (SELECT *, avg(px) OVER (PARTITION BY image_id, view) AS m FROM v3)") + f"""SELECT image_id, CAST(view AS INTEGER) AS view, CAST(pos AS INTEGER) AS pos,
  CAST(CASE WHEN view = 0 THEN px ELSE least(greatest(floor(m + (px - m) * (0.8 + 0.4 * {u_sql(42, 'image_id', 'view', repr('contrast'))})), 0), 255) END AS INTEGER) AS px FROM v4""")
def image_views(t: Tables):
    return _long(jobs.image_views(color(t), 4, 42), keep=("image_id", "view"))


# --- files ----------------------------------------------------------------------------------


def _png(rgb: bytes, h: int, w: int) -> bytes:
    """A PNG of 8-bit RGB rows."""

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = b"".join(b"\0" + rgb[y * w * 3:(y + 1) * w * 3] for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _folder(path: str):
    """The file system and the folder of an address, made if missing; runs in the tasks."""
    system, root = fs.FileSystem.from_uri(path)
    system.create_dir(root, recursive=True)
    return system, root


def _write_files(df, path: str, encode) -> None:
    """Write one file per row ``(name, ...)`` in the tasks; a retried task writes the same files again."""
    path = address(df.sparkSession, path)

    def write(batches):
        system, root = _folder(path)
        for batch in batches:
            for row in batch.itertuples():
                with system.open_output_stream(f"{root}/{row.name}") as out:
                    out.write(encode(row))
            yield pd.DataFrame({"n": [len(batch)]})

    df.mapInPandas(write, "n BIGINT").agg(F.sum("n")).first()


def _write_records(df, path: str, encode) -> None:
    """Write one file of records per task."""
    path = address(df.sparkSession, path)

    def write(batches):
        system, root = _folder(path)
        with system.open_output_stream(f"{root}/part-{TaskContext.get().partitionId()}.bin") as out:
            for batch in batches:
                for row in batch.itertuples():
                    out.write(encode(row))
                yield pd.DataFrame({"n": [len(batch)]})

    df.mapInPandas(write, "n BIGINT").agg(F.sum("n")).first()


def _write_headered(df, images: str, labels: str, h: int, w: int) -> None:
    """Write a file of pictures and one of labels per task, each with its header; sizes are put in at the end."""
    images, labels = address(df.sparkSession, images), address(df.sparkSession, labels)

    def write(batches):
        part = f"part-{TaskContext.get().partitionId():05d}"
        rows = pd.concat(list(batches), ignore_index=True)  # a small table, one file per task
        for path, head, body in (
            (images, struct.pack(">IIII", 0x0803, len(rows), h, w), b"".join(np.asarray(p, "uint8").tobytes() for p in rows.pixels)),
            (labels, struct.pack(">II", 0x0801, len(rows)), bytes(map(int, rows.label))),
        ):
            system, root = _folder(path)
            with system.open_output_stream(f"{root}/{part}") as out:
                out.write(head + body)
        yield pd.DataFrame({"n": [len(rows)]})

    df.mapInPandas(write, "n BIGINT").agg(F.sum("n")).first()


def _image_files(t: Tables) -> str:
    """One PNG per embedding, image i being 8 + i % 5 rows of 6 + i % 3 pixels of itself repeated; some broken, some other files."""
    path = scratch_path(t.spark, "images")
    ending = F.when(F.col("image_id") % 10 == 9, ".txt").otherwise(".png")
    files = color(t).select(
        F.concat(F.lit("img"), F.col("image_id"), ending).alias("name"),
        (F.col("image_id") % 20 == 3).alias("broken"),
        (8 + F.col("image_id") % 5).cast("int").alias("rows"),
        (6 + F.col("image_id") % 3).cast("int").alias("wide"),
        "pixels",
    )

    def encode(row) -> bytes:
        data = np.asarray(row.pixels, "uint8").tobytes() * 2
        return b"not an image" if row.broken else _png(data, int(row.rows), int(row.wide))

    _write_files(files, path, encode)
    return path


_FILES = """files AS (SELECT vec_id, label, concat('img', vec_id, '.png') AS image, CAST(8 + vec_id % 5 AS INTEGER) AS height,
  CAST(6 + vec_id % 3 AS INTEGER) AS width FROM embeddings WHERE vec_id % 10 <> 9 AND vec_id % 20 <> 3)"""


@query("scan_image_dir", with_(_FILES) + "SELECT image, height, width, 3 AS channels, height * width * 3 AS bytes FROM files")
def scan_image_dir(t: Tables):
    images = scans.read_image_dir(t.spark, _image_files(t))
    return images.select("image", "height", "width", "channels", F.length("data").alias("bytes"))


def _mapping(t: Tables):
    name = F.concat(F.lit("img"), "vec_id", F.lit(".png"))
    return t.embeddings.select(name.alias("image"), "label")


@query("scan_labelled_images", with_(_FILES, GRAY, COLOR) + """SELECT image, any_value(f.label) AS label,
  md5(string_agg(CAST(px AS INTEGER), ',' ORDER BY i)) AS pixels
  FROM (SELECT *, unnest(range(height * width * 3)) AS i FROM files) f
  JOIN color c ON image_id = vec_id AND pos = (i - i % 3 + 2 - i % 3) % 192 GROUP BY image""")
def scan_labelled_images(t: Tables):
    images = scans.with_pixels(scans.read_image_dir(t.spark, _image_files(t)))
    joined = scans.read_labelled_images(_mapping(t), images)
    return joined.select("image", "label", F.md5(F.array_join("pixels", ",")).alias("pixels"))  # B, G, R


def _sizes_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
    CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(median({c}) AS DOUBLE) AS p50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75,
    CAST(max({c}) AS DOUBLE) AS max FROM files"""


@query("image_sizes", with_(_FILES) + _sizes_sql("width") + " UNION ALL " + _sizes_sql("height"))
def image_sizes(t: Tables):
    sizes = stored(scans.read_image_sizes(t.spark, _image_files(t)).select("width", "height"), "sizes")
    d = profile.describe(sizes, ["width", "height"])
    return d.select("column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "p25", "p50", "p75", "max")


@query("class_image_sample", with_(_FILES, """c AS (SELECT label, count(*) AS n FROM files GROUP BY label),
ends AS ((SELECT label FROM c ORDER BY n DESC, label LIMIT 1) UNION (SELECT label FROM c ORDER BY n, label LIMIT 1))""") + f"""
  SELECT image, label, width, height FROM files WHERE label IN (SELECT label FROM ends)
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY {u_sql(42, 'image', repr('class'))}, image) <= 6""")
def class_image_sample(t: Tables):
    sizes = scans.read_image_sizes(t.spark, _image_files(t)).drop("path")
    labelled = stored(scans.read_labelled_images(_mapping(t), sizes), "sizes")
    return jobs.class_image_sample(labelled, "image", "label", 6, 42, ["width", "height"])


_RECORDS = with_(GRAY, COLOR) + """SELECT CAST(any_value(label) AS INTEGER) AS label, md5(string_agg(px, ',' ORDER BY pos)) AS pixels
  FROM {} GROUP BY image_id"""


@query("scan_fixed_records", _RECORDS.format("color"))
def scan_fixed_records(t: Tables):
    path = scratch_path(t.spark, "records")
    rows = color(t).select("label", "pixels")
    _write_records(rows, path, lambda row: bytes([int(row.label)]) + np.asarray(row.pixels, "uint8").tobytes())
    return scans.read_fixed_records(t.spark, path, 192).select("label", F.md5(F.array_join("pixels", ",")).alias("pixels"))


@query("scan_headered_set", _RECORDS.format("gray"))
def scan_headered_set(t: Tables):
    images, labels = scratch_path(t.spark, "images"), scratch_path(t.spark, "labels")
    _write_headered(gray(t).select("label", "pixels"), images, labels, 8, 8)
    return scans.read_headered_set(t.spark, images, labels).select("label", F.md5(F.array_join("pixels", ",")).alias("pixels"))
