"""A quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target text and one of the raw corpus, give
each document the mean log ratio of its n-grams. Documents are drawn without replacement by
Gumbel top-k: the k largest of sharpness x log ratio + Gumbel noise.

The n-grams are all runs of four bytes, and for each pair of neighbouring words whether the
second repeats the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import slices, stored, text_of
from tabprep.llm.words import SOLID, Words, mix

#: Bytes of text whose n-grams are held at once.
HELD = 1 << 18
#: Hash bits of an n-gram; the two last buckets are those of the word pairs.
BITS = 20
GRAM = 4
#: Target documents that the target model is fitted on, at most; those with the highest hashes of their key.
SAMPLE = 50_000
#: Added to every count.
PRIOR = 1.0
#: What a mean log ratio of one nat weighs against the noise.
SHARPNESS = 1000.0
#: Scores are compared in steps of one over this.
STEPS = 1e6


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and the text each belongs to."""
    words = Words(column, SOLID, lower=False)
    data, borders = words.data, words.borders
    places = max(0, len(data) - GRAM + 1)
    text = np.repeat(np.arange(len(column)), np.diff(borders))
    value = np.zeros(places, np.uint64)
    for k in range(GRAM):
        value = value << np.uint64(8) | data[k : k + places].astype(np.uint64)
    bucket = (mix(value + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64)
    bucket[bucket >= (1 << BITS) - 2] = 0
    whole = text[:places] == text[GRAM - 1 :][:places]
    owner = np.repeat(np.arange(len(column)), np.diff(words.first))
    pair = owner[1:] == owner[:-1]
    same = (words.hashes[1:] == words.hashes[:-1])[pair]
    return np.concatenate([bucket[whole], (1 << BITS) - 2 + same]), np.concatenate([text[:places][whole], owner[1:][pair]])


@dataclass(frozen=True)
class Ratio:
    """Log ratio of the two models per bucket."""

    log: np.ndarray

    @classmethod
    def of(cls, target: np.ndarray, raw: np.ndarray) -> Ratio:
        # the raw counts as they would be in as much text as the target's, so that a rare
        # n-gram, absent from the target by chance, says little
        expected = raw * (target.sum() / max(1.0, raw.sum()))
        return cls(np.log((target + PRIOR) / (expected + PRIOR)).astype(np.float32))

    def mean(self, column: pa.Array) -> np.ndarray:
        bucket, text = grams(column)
        n = np.bincount(text, minlength=len(column))
        total = np.bincount(text, weights=self.log[bucket], minlength=len(column))
        return total / np.maximum(n, 1)


def clean_labels(labels: DataFrame, key: str) -> DataFrame:
    """``key, clean``: whether every label of a document says good quality and not toxic.

    Rows with a null key or label say nothing.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    return known.groupBy(key).agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean"))


def fit(df: DataFrame, key: str, text: str, labels: DataFrame) -> Ratio:
    """The models: raw from all documents, target from at most SAMPLE documents labelled clean.

    ``labels`` has ``key`` and ``clean``. One pass over the texts: a task adds up its texts'
    n-grams and gives its counts, which Spark sums by bucket; 2**BITS sums reach the driver.
    """
    chosen = labels.filter("clean").select(key, F.shiftright(F.xxhash64(key), 2).alias("h"))
    cut = cut_off(chosen, "h", SAMPLE)
    chosen = chosen if cut is None else chosen.filter(F.col("h") >= cut)
    docs = df.select(F.col(key), text_of(text).alias("text")).join(
        F.broadcast(chosen.select(F.col(key), F.lit(True).alias("target"))), key, "left"
    ).select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for part in slices(batches, 0, HELD):
            bucket, text = grams(part.column(0))
            raw += np.bincount(bucket, minlength=1 << BITS)
            chosen = part.column(1).to_numpy(zero_copy_only=False)[text]
            if chosen.any():
                target += np.bincount(bucket[chosen], minlength=1 << BITS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    sums = docs.mapInArrow(run, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = np.zeros((2, 1 << BITS), np.float64)
    for bucket, raw, target in sums.collect():  # at most 2**BITS rows
        counts[:, bucket] = target, raw
    return Ratio.of(*counts)


def log_ratio(spark: SparkSession, model: Ratio, text: F.Column) -> F.Column:
    """The mean log ratio of a text's n-grams; 0 for a text without any. The model, of fixed size, is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def mean(texts: pd.Series) -> pd.Series:
        out = [shared.value.mean(part.column(0)) for part in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])], 0, HELD)]
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return mean(text)


def perturbed(ratio: F.Column, key: F.Column, seed: int) -> F.Column:
    """Sharpness x log ratio + Gumbel noise, in whole steps. The noise is a hash of seed and key."""
    u = (F.xxhash64(F.lit(seed), key).bitwiseAND((1 << 52) - 1) + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.floor((F.lit(SHARPNESS) * ratio - F.log(-F.log(u))) * F.lit(STEPS)).cast("long")


def cut_off(scores: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a column of whole numbers, or None if there are fewer.

    Counts per equal range close in on it; the driver sees at most 4096 counts a round.
    """
    if k <= 0:
        return None
    low, high, n = scores.agg(F.min(column), F.max(column), F.count(column)).first()
    if n < k:
        return None
    while low < high:
        step = (high - low) // 4096 + 1
        ranges = scores.filter(F.col(column).between(low, high)).groupBy(F.expr(f"({column} - ({low}L)) div {step}L").alias("r")).count()
        for r, n in sorted(ranges.collect(), reverse=True):
            if n >= k:
                low, high = low + r * step, min(high, low + r * step + step - 1)
                break
            k -= n
    return low


def resample(df: DataFrame, key: str, text: str, labels: DataFrame, seed: int = 42) -> tuple[DataFrame, F.Column]:
    """``key, log_ratio, score, kept`` of every document, and ``kept`` as a condition on ``df``'s rows.

    ``labels`` has ``key, quality, toxic``. k is the number of documents times the share of clean ones among the
    labelled; without labels all stay. Rows that tie with the k-th stay with it, so repeated
    rows share their lot, while copies under other keys have noise of their own. Null and empty texts have a log ratio of 0; a null key is a key
    like any other but has no label. An empty table gives an empty result; other columns are not read.

    Two passes over the texts; the condition is a third one over its input and needs no shuffle.
    """
    spark = df.sparkSession
    told = stored(clean_labels(labels, key), "labels")
    known, clean = told.agg(F.count("*"), F.count(F.when(F.col("clean"), 1))).first()
    model = fit(df, key, text, told)
    ratio = log_ratio(spark, model, text_of(text))
    scored = df.select(F.col(key), ratio.alias("log_ratio")).withColumn("score", perturbed(F.col("log_ratio"), F.col(key), seed))
    rows = stored(scored, "scores")
    k = round(rows.count() * clean / known) if known else rows.count()
    cut = cut_off(rows, "score", k)
    if cut is None:
        kept = F.lit(k > 0)
        return rows.withColumn("kept", kept), kept
    return rows.withColumn("kept", F.col("score") >= cut), perturbed(ratio, F.col(key), seed) >= cut
