"""The query list: a Spark callable and, where SQL can say it, the same result in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Input tables as attributes, read when used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for work that is heavy per row, over at least as many tasks as there are cores.

        A small file is one row group and so one task. A table with enough input
        partitions is read as it is, without a shuffle.
        """
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name``."""

    def add(f: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def u_sql(seed: int | str, *parts: str) -> str:
    """``functions.seeded.u`` in SQL; parts are SQL expressions."""
    text = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(('0x'||substr(md5(concat_ws('|','{seed}',{text})),1,8))::BIGINT/4294967296.0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
