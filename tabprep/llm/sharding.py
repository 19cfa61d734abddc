"""Shards by jump consistent hashing.

Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm" (2014): a key jumps
from shard to shard as shards are appended, and its last jump below the shard count is its
shard. No ring is kept; one more shard takes the rows that jump into it and moves no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import stored, text_of

#: The multiplier of the paper's generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; about ln(shards) vector steps."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = np.ascontiguousarray(keys).view(np.uint64).copy()
    at = np.zeros(len(key), np.int64)
    moving = np.arange(len(key))
    while len(moving):
        key[moving] = k = key[moving] * MULTIPLIER + np.uint64(1)
        to = ((at[moving] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        inside = to < shards
        moving = moving[inside]
        at[moving] = to[inside]
    return at.astype(np.int32)


def shard_of(key: F.Column, shards: int) -> F.Column:
    """The shard of a key of any type. A null key is a key like any other."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return place(F.xxhash64(key))


def assign(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """Every row's shard, its slot there, and its shard after one more was appended.

    Returns ``key, size, text_crc32, law, shard, slot, grown_shard``. ``size`` is the UTF-8
    length of the text plus 8. Slots count from 0 within a shard in the order of the key.

    Null text has size 8 and the checksum of the empty text; a null key is placed as one
    key and comes first. Equal keys share a shard; repeated rows all stay, in slots side by
    side. An empty table gives an empty result; other columns are not read.

    The text ends at the scan: what moves is one narrow row per document, dealt by ranges
    of (shard, key), so no task grows with a shard. Offsets are sums of counts per range.
    """
    narrow = df.select(
        F.col(key).alias("key"),
        (F.octet_length(text_of(text)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text_of(text)).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    order = ["shard", "key", "text_crc32", "size"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shards, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            own = batch.column("shard").to_numpy()
            # rows come ordered by shard, so a row's place is its distance from its shard's first row
            first = np.searchsorted(own, own, side="left")
            local = np.arange(len(own)) - first + seen[own]
            seen += np.bincount(own, minlength=shards)
            yield batch.append_column("local", pa.array(local, pa.int64())).append_column("part", pa.array(np.full(len(own), part), pa.int32()))

    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(dealt.mapInArrow(number, _schema(narrow)), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    return rows.join(offsets, ["shard", "part"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("local")).alias("slot"), "grown_shard",
    )


def _schema(narrow: DataFrame):
    from pyspark.sql.types import IntegerType, LongType, StructType

    return StructType(list(narrow.schema.fields)).add("local", LongType()).add("part", IntegerType())


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """The rows as one folder of Parquet files per shard."""
    df.withColumn("shard", shard_of(F.col(key), shards)).write.partitionBy("shard").parquet(path)
