"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tabprep", cores: str | int = "*") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabprep-"))
    return os.path.dirname(sc.getCheckpointDir())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/tabprep-{uuid.uuid4().hex[:12]}/{name}"


def address(spark: SparkSession, path: str) -> str:
    """The full address of a path: one without a scheme lies on the cluster's default file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return with_authority(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString())


def with_authority(full: str) -> str:
    """An address as ``scheme://...``, also where Hadoop writes ``scheme:/...``."""
    scheme, _, rest = full.partition(":")
    return full if rest.startswith("//") else f"{scheme}://{rest}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and drop the lineage.

    Freezes partition ids and survives the loss of executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet into the shared folder and read back.

    As ``cut``, and later reads take only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
