"""Scans, sinks, images and models."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.catalog.images import _png
from tabprep.functions import pixels as P
from tabprep.plans import images as jobs
from tabprep.plans import models
from tabprep.sources import binary, readers, writers
from tabprep.sources import images as scans
from tabprep.sources.dimensions import dimensions


def test_csv_survives_quotes_and_line_breaks(spark, tmp_path):
    rows = [(1, 'a "quoted", text'), (2, "two\nlines\r\nand more"), (3, " blanks "), (4, ""), (5, None), (6, "\\")]
    df = spark.createDataFrame(rows, "k INT, t STRING")
    writers.write_csv(df, str(tmp_path / "c"))
    got = sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "c"), "k INT, t STRING").collect()))
    rows[3] = (4, None)  # an empty field reads as missing
    assert got == rows


@pytest.mark.parametrize("lines", ["traindata=[\n5.1\t3.5\t1\n4.9\t3.0\t2\n];\n", "5.1 3.5 1 \n4.9 3.0 2 \n"])
def test_matrix(spark, tmp_path, lines):
    (tmp_path / "m.txt").write_text(lines)
    got = readers.read_matrix(spark, str(tmp_path / "m.txt"), row="row").orderBy("row").collect()
    assert [(r.features, r.label) for r in got] == [([5.1, 3.5], 1), ([4.9, 3.0], 2)]


def test_pair_log_strips(spark, tmp_path):
    df = spark.createDataFrame([(" a b \n", "\tc\nd ")], "x STRING, y STRING")
    writers.write_pair_log(df, str(tmp_path / "l"), "x", "y")
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a b|||c d"]


def test_image_folder(spark, tmp_path):
    rgb = bytes(range(2 * 3 * 3))
    (tmp_path / "a.png").write_bytes(_png(rgb, 2, 3))
    (tmp_path / "b.png").write_bytes(b"broken")
    (tmp_path / "c.PNG").write_bytes(_png(rgb, 2, 3))
    (tmp_path / ".DS_Store").write_bytes(b"x")
    images = scans.with_pixels(scans.read_image_dir(spark, str(tmp_path)))
    (r,) = images.collect()
    assert (r.image, r.height, r.width, r.channels) == ("a.png", 2, 3, 3)
    assert r.pixels[:6] == [2, 1, 0, 5, 4, 3]
    mapping = spark.createDataFrame([("a.png", "x"), ("gone.png", "y")], "image STRING, cultivar STRING")
    assert [x.cultivar for x in scans.read_labelled_images(mapping, images).collect()] == ["x"]


def test_binary_sets(spark, tmp_path):
    pixels = [bytes([i] * 6) for i in (9, 200, 255)]
    (tmp_path / "r.bin").write_bytes(b"".join(bytes([k]) + p for k, p in enumerate(pixels)))
    got = scans.read_fixed_records(spark, str(tmp_path / "r.bin"), 6).orderBy("position").collect()
    assert [tuple(r) for r in got] == [("r.bin", 0, 0, [9] * 6), ("r.bin", 1, 1, [200] * 6), ("r.bin", 2, 2, [255] * 6)]
    (tmp_path / "img").write_bytes(struct.pack(">IIII", 2051, 3, 2, 3) + b"".join(pixels))
    (tmp_path / "lab").write_bytes(struct.pack(">II", 2049, 3) + bytes([7, 0, 200]))
    rows = scans.read_headered_set(spark, str(tmp_path / "img"), str(tmp_path / "lab")).orderBy("position").collect()
    assert [(r.label, r.pixels) for r in rows] == [(7, [9] * 6), (0, [200] * 6), (200, [255] * 6)]


def test_ranges_hold_whole_records_and_batches_are_cut(tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "BATCH_BYTES", 30)
    rng = np.random.default_rng(1)
    folder = tmp_path / "a set"
    folder.mkdir()
    sets = {name: rng.integers(0, 256, (n, 7), np.uint8) for name, n in (("b", 23), ("a", 1), ("empty", 0))}
    for name, rows in sets.items():
        (folder / name).write_bytes(rows.tobytes())
    (folder / "_SUCCESS").write_bytes(b"")
    reader = binary.RecordReader({"path": f"file://{folder}", "pixels": "6", "split": "70"})
    parts = reader.partitions()
    assert [(p.path[-1], p.first, p.records) for p in parts] == [("a", 0, 1), ("b", 0, 10), ("b", 10, 10), ("b", 20, 3)]
    got = [r for p in parts for batch in reader.read(p) for r in batch.to_pylist()]
    want = [(name, i, row[0], row[1:].tobytes()) for name in ("a", "b") for i, row in enumerate(sets[name])]
    assert [(r["file"], r["position"], r["label"], r["data"]) for r in got] == want
    assert max(b.num_rows for p in parts for b in reader.read(p)) == 4


def test_a_large_headered_file_is_split(tmp_path):
    n, size = 4_000_000, 28 * 28
    for name, head, length in (("img", struct.pack(">IIII", 2051, n, 28, 28), n * size), ("lab", struct.pack(">II", 2049, n), n)):
        with open(tmp_path / name, "wb") as f:  # three gigabytes of holes, which take no disk
            f.write(head)
            f.truncate(len(head) + length)
    with open(tmp_path / "img", "r+b") as f:
        f.seek(16 + (n - 1) * size)
        f.write(bytes([5]) * size)
    reader = binary.RecordReader({"path": f"file://{tmp_path}/img", "labels": f"file://{tmp_path}/lab"})
    parts = reader.partitions()
    assert len(parts) == -(-n // (binary.SPLIT_BYTES // size)) and sum(p.records for p in parts) == n
    last = list(reader.read(parts[-1]))
    assert sum(b.num_rows for b in last) == parts[-1].records and max(b.nbytes for b in last) < 2 * binary.BATCH_BYTES
    assert last[-1].column(1)[-1].as_py() == n - 1 and last[-1].column(3)[-1].as_py() == bytes([5]) * size


def test_files_that_do_not_fit_are_refused(tmp_path):
    (tmp_path / "odd").write_bytes(b"12345")
    with pytest.raises(ValueError):
        binary.RecordReader({"path": f"file://{tmp_path}/odd", "pixels": "6"}).partitions()
    (tmp_path / "img").write_bytes(struct.pack(">IIII", 2051, 3, 2, 3) + bytes(17))
    (tmp_path / "lab").write_bytes(struct.pack(">II", 2049, 3) + bytes(3))
    for images, labels in (("img", "lab"), ("lab", "img"), ("odd", "lab")):
        with pytest.raises(ValueError):
            binary.RecordReader({"path": f"file://{tmp_path}/{images}", "labels": f"file://{tmp_path}/{labels}"}).partitions()
    with pytest.raises(FileNotFoundError):
        binary.RecordReader({"path": f"file://{tmp_path}/gone", "pixels": "6"}).partitions()


def jpeg(width, height, before=b"", marker=0xC0):
    return b"\xff\xd8" + before + b"\xff" + bytes([marker]) + struct.pack(">HBHHB", 8, 8, height, width, 1) + b"\xff\xda"


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (_png(bytes(18), 2, 3), (3, 2)),
        (b"GIF89a" + struct.pack("<HH", 40, 30) + b"rest", (40, 30)),
        (b"BM" + bytes(12) + struct.pack("<Iii", 40, 31, -17), (31, 17)),
        (b"BM" + bytes(12) + struct.pack("<IHH", 12, 9, 8), (9, 8)),
        (jpeg(640, 480), (640, 480)),
        (jpeg(64, 48, b"\xff\xe1" + struct.pack(">H", 60_002) + bytes(60_000), 0xC2), (64, 48)),  # beyond the first bytes read
        (jpeg(5, 6, b"\xff\xff\xd0\xff\xc4" + struct.pack(">H", 4) + b"\xff\xc0"), (5, 6)),
        (jpeg(5, 6, b"\xff\xda"), None),
        (jpeg(0, 6), None),
        (jpeg(5, 6)[:8], None),
        (b"\xff\xd8" + b"\xff\xe1" + struct.pack(">H", 1), None),
        (_png(bytes(18), 2, 3)[:20], None),
        (b"BM" + bytes(5), None),
        (b"", None),
        (b"not an image", None),
    ],
)
def test_sizes_from_headers(raw, want):
    assert dimensions(lambda start, size: raw[start : start + size]) == want


def test_image_sizes_of_a_folder(spark, tmp_path):
    (tmp_path / "a b.png").write_bytes(_png(bytes(18), 2, 3))
    (tmp_path / "c.jpg").write_bytes(jpeg(7, 8))
    (tmp_path / "broken.bmp").write_bytes(b"x")
    (tmp_path / "other.txt").write_bytes(_png(bytes(18), 2, 3))
    got = scans.read_image_sizes(spark, str(tmp_path)).orderBy("width").collect()
    assert [(r.image, r.width, r.height) for r in got] == [("a b.png", 3, 2), ("c.jpg", 7, 8)]


@pytest.fixture(scope="module")
def picture(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (7, 5, 3))
    df = spark.createDataFrame([(1, 7, 5, 3, a.ravel().tolist())], "image_id INT, h INT, w INT, c INT, pixels ARRAY<INT>")
    return a, df


def test_geometry(picture):
    a, df = picture
    out = lambda f: np.array(df.select(f(F.col("pixels"), F.col("h"), F.col("w"), F.col("c"))).first()[0])
    assert (out(P.flip_h) == a[:, ::-1].ravel()).all()
    assert (out(P.flip_v) == a[::-1].ravel()).all()
    assert (out(P.hwc_to_chw) == a.transpose(2, 0, 1).ravel()).all()
    up = out(lambda p, h, w, c: P.resize_nearest(p, h, w, c, F.lit(14), F.lit(10)))
    assert (up == a.repeat(2, 0).repeat(2, 1).ravel()).all()
    th, tw = P.short_side(F.col("h"), F.col("w"), 10)
    assert tuple(df.select(th, tw).first()) == (14, 10)


def plain_equalize(img, clip, rows, cols):
    """Straight loops over tiles and pixels."""
    h, w = img.shape
    if h % rows or w % cols:
        img2 = np.pad(img, ((0, rows - h % rows), (0, cols - w % cols)), mode="reflect")
    else:
        img2 = img
    th, tw = img2.shape[0] // rows, img2.shape[1] // cols
    tables = {}
    for i in range(rows):
        for j in range(cols):
            hist = [0] * 256
            for v in img2[i * th:(i + 1) * th, j * tw:(j + 1) * tw].ravel():
                hist[v] += 1
            limit = max(1, int(clip * th * tw / 256))
            over = sum(max(n - limit, 0) for n in hist)
            hist = [min(n, limit) + over // 256 for n in hist]
            left = over % 256
            for v in range(0, 256, max(256 // left, 1) if left else 256):
                if left:
                    hist[v] += 1
                    left -= 1
            total, table = 0, []
            for n in hist:
                total += n
                table.append(min(round(total * (255.0 / (th * tw))), 255))
            tables[i, j] = table
    out = np.zeros((h, w), int)
    for y in range(h):
        for x in range(w):
            fy, fx = y / th - 0.5, x / tw - 0.5
            y0, x0 = int(np.floor(fy)), int(np.floor(fx))
            dy, dx = fy - y0, fx - x0
            ys, xs = (max(y0, 0), min(y0 + 1, rows - 1)), (max(x0, 0), min(x0 + 1, cols - 1))
            v = img[y, x]
            top = tables[ys[0], xs[0]][v] * (1 - dx) + tables[ys[0], xs[1]][v] * dx
            low = tables[ys[1], xs[0]][v] * (1 - dx) + tables[ys[1], xs[1]][v] * dx
            out[y, x] = round(top * (1 - dy) + low * dy)
    return out


@pytest.mark.parametrize("shape,tiles,clip", [((8, 8), (2, 2), 40), ((11, 9), (2, 3), 6), ((20, 12), (4, 4), 2)])
def test_equalize(spark, shape, tiles, clip):
    a = np.random.default_rng(7).integers(0, 256, shape)
    row = (1, *shape, 1, a.ravel().tolist())
    df = spark.createDataFrame([row], "image_id INT, h INT, w INT, c INT, pixels ARRAY<INT>")
    got = np.array(jobs.equalize(df, clip, *tiles).first().pixels).reshape(shape)
    assert (got == plain_equalize(a, clip, *tiles)).all()


def test_hsv_round_trip_is_close(spark):
    rows = [(r, g, b) for r in range(0, 256, 51) for g in range(0, 256, 51) for b in range(0, 256, 51)]
    df = spark.createDataFrame(rows, "r INT, g INT, b INT").withColumn("q", P.rgb_to_hsv(F.col("r"), F.col("g"), F.col("b")))
    back = df.withColumn("z", P.hsv_to_rgb(F.col("q.h"), F.col("q.s"), F.col("q.v"))).collect()
    for x in back:
        assert x.q.v == max(x.r, x.g, x.b)
        assert max(abs(x.z.r - x.r), abs(x.z.g - x.g), abs(x.z.b - x.b)) <= 5


def test_views_keep_the_plain_image_first(picture):
    a, df = picture
    views = {r.view: r.pixels for r in jobs.image_views(df, 3, 1).collect()}
    assert views[0] == a.ravel().tolist() and set(views) == {0, 1, 2}


def test_prepared_values(picture):
    _, df = picture
    mean, std = (0.5, 0.5, 0.5), (0.5, 0.5, 0.5)
    r = jobs.image_prepare(df, (4, 4), mean, std, label=None, tiles=(2, 2)).first()
    assert len(r["values"]) == 48 and -1 <= min(r["values"]) and max(r["values"]) <= 1


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(11)
    centers = [(0, 0), (4, 0), (0, 4)]
    rows = [(i, *(float(x) for x in rng.normal(centers[i % 3], 0.5)), i % 3) for i in range(150)]
    return spark.createDataFrame(rows, "k INT, a DOUBLE, b DOUBLE, label INT").cache()


def test_learners_separate_blobs(blobs, tmp_path):
    from tabprep.operators.evaluate import accuracy

    tree = models.tree_fit(blobs, ["a", "b"], "label")
    assert accuracy(models.score_batch(blobs, tree, ["k", "label"])).first()[0] == 1.0
    net = models.mlp_fit(blobs, ["a", "b"], "label", 3)
    scored = models.score_batch(blobs, net, ["k", "label"])
    assert accuracy(scored).first()[0] > 0.97
    assert all(abs(sum(r.probs) - 1) < 1e-9 for r in scored.collect())
    models.save_model(net, str(tmp_path / "m"))
    again = models.score_batch(blobs, models.load_model(str(tmp_path / "m")), ["k", "label"])
    assert sorted(again.select("k", "prediction").collect()) == sorted(scored.select("k", "prediction").collect())


def test_pair_classifier_beats_chance(spark):
    from tabprep.catalog.fixtures import pairs
    from tabprep.catalog.registry import Tables
    from tabprep.operators.evaluate import accuracy

    data = models.pair_features(pairs(Tables(spark, "/root/testdata/sf0.01"))).cache()
    model = models.pair_classifier(data)
    assert accuracy(models.score_batch(data, model, ["id", "label"])).first()[0] > 0.6


def test_matrix_keeps_every_row_and_refuses_bad_cells(spark, tmp_path):
    (tmp_path / "m.txt").write_text("a = [\n1 nan 0\n -Inf\t2e3 1 \n\n+inf -.5 2\n];\n")
    got = readers.read_matrix(spark, str(tmp_path / "m.txt"), row="row").orderBy("row").collect()
    assert [r.label for r in got] == [0, 1, 2]
    assert str([r.features for r in got]) == "[[1.0, nan], [-inf, 2000.0], [inf, -0.5]]"
    (tmp_path / "bad.txt").write_text("1 2 0\n1 x 0\n")
    with pytest.raises(Exception, match="not a number"):
        readers.read_matrix(spark, str(tmp_path / "bad.txt")).collect()


def test_scoring_by_stored_weights_loads_once_per_worker(spark, tmp_path):
    from tabprep.plans import external

    rng = np.random.default_rng(1)
    w1, b1, w2, b2 = rng.normal(size=(3, 4)), rng.normal(size=3), rng.normal(size=(2, 3)), rng.normal(size=2)
    path = str(tmp_path / "deep" / "weights.npz")
    external.save_weights(spark, path, w1=w1, b1=b1, w2=w2, b2=b2)
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "k INT, v ARRAY<DOUBLE>").repartition(3)
    for batch in (7, 1024):
        got = external.score(df, "v", external.perceptron(f"file://{path}"), 4, batch).orderBy("k").collect()
        z = 1 / (1 + np.exp(-(x @ w1.T + b1))) @ w2.T + b2
        want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        assert np.allclose([r.probs for r in got], want) and [r.prediction for r in got] == want.argmax(axis=1).tolist()


def test_pooling_adds_up_whole_vectors(spark):
    from tabprep.operators import vectors

    rows = [("a", [1.0, -2.0]), ("a", [3.0, -4.0]), ("b", [5.0, 6.0]), (None, [7.0, 8.0]), ("a", None)]
    df = spark.createDataFrame(rows, "g STRING, v ARRAY<FLOAT>").repartition(3)
    assert {r.g: r.pooled for r in vectors.pool_vectors(df, "g", "v").collect()} == {"a": [2.0, -3.0, 3.0, -2.0], "b": [5.0, 6.0] * 2, None: [7.0, 8.0] * 2}
    assert "Generate" not in vectors.pool_vectors(df, "g", "v")._jdf.queryExecution().executedPlan().toString()
    views = vectors.view_average(df.withColumnRenamed("g", "k"), "k", "v").collect()
    assert {r.k: (r.v, r.prediction) for r in views} == {"a": ([2.0, -3.0], 0), "b": ([5.0, 6.0], 1), None: ([7.0, 8.0], 1)}
    assert vectors.pool_vectors(df.limit(0), "g", "v").count() == 0
