"""Filters, null handling, imputation and label dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators.joins import lookup_join
from tabprep.operators.prefix import with_ordinal
from tabprep.operators.quantiles import exact_quantiles

# fixed values: image file suffixes
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "gif", "tiff")


def feature_label_split(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """All columns but the last as ``features``; the last as an integer ``label``."""
    *features, label = cols
    return df.select(
        *keep,
        F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
        F.col(label).cast("int").alias("label"),
    )


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Drop a sentinel value; NULL rows stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def has_suffix(path: Column, suffixes: Sequence[str] = IMAGE_SUFFIXES) -> Column:
    """Case-insensitive test of the file suffix."""
    return F.lower(path).rlike(r"\.(" + "|".join(suffixes) + r")$")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` in one pass."""
    counts = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in (cols or df.columns)
    ]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def table_info(df: DataFrame) -> DataFrame:
    """``(column, type, non_null, rows)`` in one pass."""
    info = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(f.name).alias("non_null"),
            F.count(F.lit(1)).alias("rows"),
        )
        for f in df.schema
    ]
    return df.agg(F.array(*info).alias("i")).select(F.inline("i"))


def head_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def impute_median(df: DataFrame, column: str, fit: DataFrame | None = None) -> DataFrame:
    """Fill NULLs by the exact median of ``fit`` (default: the table itself)."""
    median = exact_quantiles(df if fit is None else fit, [column], [0.5]).select("q0").scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value, the smallest on ties."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.agg(F.min_by(column, F.struct(-F.col("count"), F.col(column))).alias(column))


def impute_mode(df: DataFrame, column: str, fit: DataFrame | None = None) -> DataFrame:
    """Fill NULLs by the most frequent value of ``fit`` (default: the table itself)."""
    mode = most_frequent(df if fit is None else fit, column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mode))


def map_categories(column: Column, mapping: Mapping) -> Column:
    """Replace values by a dictionary; others become NULL."""
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])[column]


def label_dictionary(df: DataFrame, label: str, row_key: str) -> DataFrame:
    """``(label, label_index)``: labels numbered from 0 in order of first appearance by ``row_key``."""
    first = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.min(row_key).alias("_first"))
    numbered = with_ordinal(first, "_first", label)
    return numbered.select(label, (F.col("ordinal") - 1).cast("int").alias("label_index"))


def label_index(df: DataFrame, label: str, row_key: str) -> tuple[DataFrame, DataFrame]:
    """The table with ``label_index`` added (NULL where the label is), and the dictionary."""
    dictionary = label_dictionary(df, label, row_key)
    return lookup_join(df, dictionary, label, "left", F.col(row_key)), dictionary


def label_decode(df: DataFrame, dictionary: DataFrame, salt_by: Column | None = None) -> DataFrame:
    """Add the label of ``label_index``; NULL where the dictionary has none."""
    return lookup_join(df, dictionary, "label_index", "left", salt_by)


def label_map_check(df: DataFrame, index: str, name: str) -> DataFrame:
    """``(labels, one_to_one)``: is the dictionary one-to-one in both directions?"""
    seen = df.select(index, name).distinct()
    n_index, n_name, n = F.count_distinct(index), F.count_distinct(name), F.count(F.lit(1))
    return seen.agg(n_index.alias("labels"), ((n_index == n) & (n_name == n)).alias("one_to_one"))


def submission(keys: DataFrame, predictions: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``(key, out)`` for every key; NULL where no prediction exists."""
    return keys.select(key).join(predictions.select(key, F.col(value).alias(out)), key, "left")


def on_error_keep(changed: Column, before: Column) -> Column:
    """A failed step (NULL) leaves the value as it was."""
    return F.coalesce(changed, before)


def on_error_drop(df: DataFrame, changed: str) -> DataFrame:
    """A failed step (NULL) drops the row."""
    return df.filter(F.col(changed).isNotNull())
