"""Vector jobs on tables: class scoring, pooling, view averaging, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions import vectors as V


def cosine_scores(df: DataFrame, vector: Column, unit_rows: Column, out: str = "cosines") -> DataFrame:
    """Add the cosine of each vector to every class; ``unit_rows`` as from ``class_matrix``."""
    return df.withColumn(out, V.cosine_scores(vector, unit_rows))


def class_probabilities(
    df: DataFrame, vector: Column, unit_rows: Column, scale: float = 30.0, out: str = "probs"
) -> DataFrame:
    """softmax(scale * cosine to every class)."""
    scored = cosine_scores(df, vector, unit_rows, "_cos")
    logits = scored.withColumn("_logits", V.rescale(F.col("_cos"), scale, 0.0)).drop("_cos")
    return logits.withColumn(out, V.softmax(F.col("_logits"))).drop("_logits")


def summaries(df: DataFrame, group: str, vector: str, *metrics: str) -> DataFrame:
    """``(group, *metrics)``: statistics per position over the vectors of a group, as arrays.

    Vectors are added up on the map side, so a task sends one row per group and no vector is
    taken apart. Missing vectors are left out; those of a group must have one length and no missing entry, or the job fails.
    """
    summary = Summarizer.metrics(*metrics).summary(array_to_vector(F.col(vector).cast("array<double>")))
    found = df.filter(F.col(vector).isNotNull()).groupBy(group).agg(summary.alias("_s"))
    return found.select(group, *[vector_to_array(f"_s.{m}").alias(m) for m in metrics])


def view_average(df: DataFrame, key: str, probs: str = "probs") -> DataFrame:
    """``(key, probs, prediction)``: mean class probabilities over the views of a sample."""
    mean = summaries(df, key, probs, "mean").withColumnRenamed("mean", probs)
    return mean.withColumn("prediction", V.argmax(F.col(probs)))


def pool_vectors(df: DataFrame, group: str, vector: str) -> DataFrame:
    """``(group, pooled)``: mean pool and max pool, concatenated."""
    return summaries(df, group, vector, "mean", "max").select(group, F.concat("mean", "max").alias("pooled"))


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, lo, hi)`` in one pass."""
    bounds = [
        F.struct(
            F.lit(c).alias("column"),
            F.min(F.col(c)).cast("double").alias("lo"),
            F.max(F.col(c)).cast("double").alias("hi"),
        )
        for c in cols
    ]
    return df.agg(F.array(*bounds).alias("b")).select(F.inline("b"))


def minmax_scale(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """Scale columns by the minima and maxima of ``fit`` (default: the table itself): two numbers per column, found now."""
    source = df if fit is None else fit
    bounds = [f(F.col(c)).cast("double") for c in cols for f in (F.min, F.max)]
    found = source.agg(F.array(*bounds).alias("b")).first()["b"]

    def number(x: float | None) -> Column:
        return F.lit(x).cast("double")

    return df.withColumns({c: V.minmax_scale(F.col(c), number(found[2 * i]), number(found[2 * i + 1])) for i, c in enumerate(cols)})


def mlp_forward(
    df: DataFrame, vector: Column, w1: Column, b1: Column, w2: Column, b2: Column
) -> DataFrame:
    """Adds ``probs`` and ``prediction`` of a one-hidden-layer perceptron with given weights.

    Weights come as one row per output unit.
    """
    hidden = df.withColumn("_hidden", V.sigmoid(V.affine(vector, w1, b1)))
    logits = hidden.withColumn("_logits", V.affine(F.col("_hidden"), w2, b2))
    probs = logits.withColumn("probs", V.softmax(F.col("_logits"))).drop("_hidden", "_logits")
    return probs.withColumn("prediction", V.argmax(F.col("probs")))
