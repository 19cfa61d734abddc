"""Sinks: CSV, text reports, stored probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.plans.tree import prediction_line, tree_lines
from tabprep.sources.readers import CSV_OPTIONS, read_csv


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV, one file per task, no index column."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    df.write.mode("overwrite").options(**options).csv(path)


def write_csv_keyed(df: DataFrame, path: str, key: str) -> None:
    """CSV with the key as first column."""
    write_csv(df.select(key, *[c for c in df.columns if c != key]), path)


def write_predictions(df: DataFrame, path: str, ordinal: str, label: str, prediction: str) -> None:
    """One line per sample, in the order of ``ordinal``."""
    line = prediction_line(ordinal, label, prediction).alias("value")
    df.orderBy(ordinal).select(line).write.mode("overwrite").text(path)


def write_tree(nodes: DataFrame, path: str) -> None:
    """The indented pre-order dump of a node table."""
    tree_lines(nodes).orderBy("path").select("line").write.mode("overwrite").text(path)


def write_pair_log(df: DataFrame, path: str, before: str, after: str) -> None:
    """``before|||after`` per row, both stripped; line breaks inside a text become blanks, a missing one is empty."""

    def flat(c: str):
        return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), r"[\r\n]+", " ")

    df.select(F.concat_ws("|||", flat(before), flat(after)).alias("value")).write.mode("overwrite").text(path)


def write_probabilities(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def publish_csv(spark, source: str, target: str, schema) -> None:
    """Copy a result CSV unchanged."""
    write_csv(read_csv(spark, source, schema), target)
