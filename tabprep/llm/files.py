"""Files of our own formats in the shared folder, written and read by tasks.

A task writes files under names nobody else uses and returns what it wrote as rows. The rows,
once stored, are the manifest: files of lost or repeated attempts are in no manifest.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from tabprep.session import scratch_path


def folder(spark: SparkSession, path: str) -> str:
    """The full address of a folder, its scheme included, which exists afterwards."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(hadoop)
    full = store.makeQualified(hadoop).toString()
    scheme, _, rest = full.partition(":")
    return full if rest.startswith("//") else f"{scheme}://{rest}"


def new_folder(spark: SparkSession, name: str) -> str:
    return folder(spark, scratch_path(spark, name))


def new_name(where: str, ending: str) -> str:
    return f"{where}/{uuid.uuid4().hex}{ending}"


def write(address: str, content: bytes) -> None:
    store, path = pafs.FileSystem.from_uri(address)
    with store.open_output_stream(path, compression=None) as f:  # the name must not choose one
        f.write(content)


def reader(address: str) -> pa.NativeFile:
    """An open file for reads anywhere in it; has size(), seek() and read()."""
    store, path = pafs.FileSystem.from_uri(address)
    return store.open_input_file(path)
