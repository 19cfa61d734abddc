"""Scans of image folders and binary image sets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.pixels import bytes_to_pixels
from tabprep.session import address, with_authority
from tabprep.sources.binary import Records, file_system
from tabprep.sources.dimensions import dimensions

# fixed values: suffixes of a folder listing, case-sensitive
FOLDER_GLOB = "*.{png,jpg,jpeg,bmp}"


def read_image_dir(spark: SparkSession, path: str) -> DataFrame:
    """``(image, path, height, width, channels, data)``; other files and broken images are left out.

    ``data`` holds the bytes of the image source: rows from the top, channels in B, G, R order.
    """
    files = spark.read.format("image").option("pathGlobFilter", FOLDER_GLOB).option("dropInvalid", True).load(path)
    return files.select(
        F.element_at(F.split("image.origin", "/"), -1).alias("image"),
        F.col("image.origin").alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def with_pixels(images: DataFrame) -> DataFrame:
    """``data`` as ``pixels ARRAY<INT>``."""
    return images.withColumn("pixels", bytes_to_pixels("data")).drop("data")


def read_labelled_images(mapping: DataFrame, images: DataFrame, on: str = "image") -> DataFrame:
    """Mapping rows with their image, joined by file name; rows without a file are left out."""
    return mapping.join(images, on)


def read_image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(image, path, width, height)`` of the folder's images, from their headers alone.

    A file whose header is broken is left out; what follows the header is not looked at. Files are
    listed by Spark and each is opened once, in a task.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FOLDER_GLOB).load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in batch.column(0).to_pylist():
                system, name = file_system(with_authority(at))
                with system.open_input_file(name) as f:

                    def read(start: int, size: int) -> bytes:
                        f.seek(start)
                        return f.read(size)

                    found = dimensions(read)
                if found:
                    rows.append((at.rpartition("/")[2], at, *found))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["image", "path", "width", "height"])

    return listed.mapInArrow(run, "image string, path string, width int, height int")


def _records(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(Records)
    return spark.read.format(Records.name()).options(**options).load()


def read_fixed_records(spark: SparkSession, path: str, pixels: int) -> DataFrame:
    """``(file, position, label, pixels ARRAY<INT>)`` from records of one label byte and ``pixels`` bytes.

    ``path`` is a file or a folder of files. Tasks read byte ranges of whole records. A file that is
    no whole number of records fails.
    """
    found = _records(spark, path=address(spark, path), pixels=str(pixels))
    return found.select("file", "position", "label", bytes_to_pixels("data").alias("pixels"))


def read_headered_set(spark: SparkSession, images: str, labels: str) -> DataFrame:
    """``(file, position, label, pixels ARRAY<INT>)`` from an image file and a label file with headers.

    Either two files or two folders, whose files are paired in the order of their names. Headers are
    read once, tasks read byte ranges of whole records. Files that do not hold what their headers tell of fail.
    """
    found = _records(spark, path=address(spark, images), labels=address(spark, labels))
    return found.select("file", "position", "label", bytes_to_pixels("data").alias("pixels"))
