"""Scans: CSV, numeric text matrices, stored probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed on both sides so that quotes, commas, line breaks and blanks inside a field survive.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True) -> DataFrame:
    """Headered CSV with a given schema.

    ``multiline=False`` lets Spark split large files; use it when no field has a line break.
    """
    options = CSV_OPTIONS | {"multiLine": multiline}
    return spark.read.schema(schema).options(**options).csv(path)


def read_matrix(spark: SparkSession, path: str, row: str | None = None) -> DataFrame:
    """``(features ARRAY<DOUBLE>, label INT)`` from lines of numbers, the label last.

    Blank lines and the lines that open and close a matrix, such as ``name=[`` and ``];``,
    are left out by their content, since a split of the file cannot know which line is the
    first. ``nan`` and ``inf`` are numbers; any other cell fails the job. ``row`` names a key
    column that follows the line order of a single file.
    """
    lines = spark.read.text(path)
    if row:
        lines = lines.withColumn(row, F.monotonically_increasing_id())
    data = lines.filter(~F.col("value").rlike(r"^\s*$|^\s*(\w+\s*=\s*)?\[\s*$|^\s*\]\s*;?\s*$"))

    def number(s: F.Column) -> F.Column:
        value = F.lower(s)
        sign = F.when(value.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
        plain = F.regexp_replace(value, r"^[-+]", "")
        return (
            F.when(plain == "nan", F.lit(float("nan")))
            .when(plain.isin("inf", "infinity"), sign * F.lit(float("inf")))
            .otherwise(F.coalesce(s.try_cast("double"), F.raise_error(F.concat(F.lit("not a number: "), s)).cast("double")))
        )

    cells = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    parts = data.withColumn("_x", F.transform(cells, number))
    return parts.select(
        *([row] if row else []),
        F.slice("_x", F.lit(1), F.size("_x") - 1).alias("features"),
        F.element_at("_x", -1).cast("int").alias("label"),
    )


def read_probabilities(spark: SparkSession, path: str) -> DataFrame:
    """``(id, probs ARRAY<DOUBLE>)`` from Parquet."""
    return spark.read.parquet(path)
