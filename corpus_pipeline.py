"""A corpus pipeline of five stages; each works on what the one before it kept.

Every stage takes and gives whole rows: keys may be null or repeat, texts may be null or empty, other
columns pass through whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import byte_bpe, decontaminate, importance, secrets, simhash
from tabprep.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws.

    Null and empty texts have a ratio of zero. Rows that tie with the last one drawn stay with it, so repeated rows
    share their lot. Without labels all stay.
    """
    _, kept = importance.resample(docs, "doc_id", "text", table(spark, sf_dir, "labels"))
    return docs.filter(kept)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the smallest key; of rows that repeat it, one.

    Null and empty texts share the fingerprint zero and are one group. Null keys come last.
    """
    return simhash.keep_one(docs, "doc_id", "text", length=3, bits=2)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages. Null and empty texts have none; copies of a document fare alike."""
    return decontaminate.clean(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text", size=10)


def credentials(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets other than copied examples replaced by a mark.

    A null text stays null. A null source or language counts as one of its own; copies within a repository count once there.
    """
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    found = secrets.redact(docs, "text", repository, F.col("source"))
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


#: Bytes of each generation of the encoder's memo: workers of the stages before still stand, and their heap is grown.
MEMO_BYTES = 24 << 20


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, and digests of them and of what they decode to; a null text is empty. One row per row."""
    vocabulary = byte_bpe.Vocabulary.of_file(byte_bpe.default_path())
    return byte_bpe.encode(docs, "doc_id", "text", vocabulary, decoded=True, held_bytes=MEMO_BYTES).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


#: (name, function of (spark, docs, sf_dir)).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmarks", benchmarks),
    ("credentials", credentials),
    ("tokens", tokens),
]

#: SQL cannot express the first two stages and the last; tests hold all against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
