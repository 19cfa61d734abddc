"""Scores of predictions, agreement between result sets, voting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions import vectors as V
from tabprep.operators.ranking import with_batch


def hit(label: str, prediction: str) -> Column:
    """1 where the prediction is the label, else 0; a missing one of either is no hit."""
    return F.coalesce((F.col(label) == F.col(prediction)).cast("int"), F.lit(0))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of hits among all rows."""
    return df.agg(F.avg(hit(label, prediction)).alias("accuracy"))


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(actual, predicted, n)``: at most one row per pair of classes."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(actual, predicted, n)`` for every pair of classes, zeros included."""
    cells = _cells(df, label, prediction)
    classes = cells.select(F.explode(F.array("actual", "predicted")).alias("actual")).distinct()
    every = classes.agg(F.array_sort(F.collect_set("actual"))).scalar()
    grid = classes.select("actual", F.explode(every).alias("predicted"))
    return grid.join(cells, ["actual", "predicted"], "left").fillna(0, ["n"])


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class, then accuracy, macro and weighted averages.

    Everything follows from the class-pair counts; 0/0 counts as 0.
    """
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("p"), hit.alias("t")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("t")),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    by_class = (
        _cells(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("c")
        .agg(F.sum("s").alias("support"), F.sum("p").alias("p"), F.sum("t").alias("t"))
        .withColumn("precision", ratio(F.col("t"), F.col("p")))
        .withColumn("recall", ratio(F.col("t"), F.col("support")))
        .withColumn(
            "f1",
            ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )
    cols = ["precision", "recall", "f1"]
    missing = F.lit(None).cast("double")

    def weighted(c: str) -> Column:
        return (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)

    def row(name: str, values: Sequence[Column]) -> Column:
        named = [v.alias(c) for v, c in zip(values, cols)]
        return F.struct(F.lit(name).alias("label"), *named, F.sum("support").alias("support"))

    summary = by_class.agg(
        F.array(
            row("accuracy", [missing, missing, F.sum("t") / F.sum("support")]),
            row("macro avg", [F.avg(c) for c in cols]),
            row("weighted avg", [weighted(c) for c in cols]),
        ).alias("rows")
    ).select(F.inline("rows"))
    return by_class.select(F.col("c").cast("string").alias("label"), *cols, "support").unionByName(summary)


def cross_entropy(df: DataFrame, key: str, logits: str, label: str, batch: int) -> DataFrame:
    """One row: the mean of batch means (as a training loop reports it) and the row mean."""
    losses = with_batch(df.select(key, V.cross_entropy(F.col(logits), F.col(label)).alias("loss")), key, size=batch)
    per_batch = losses.groupBy("batch_id").agg(
        F.avg("loss").alias("mean"), F.sum("loss").alias("sum"), F.count("loss").alias("n")
    )
    return per_batch.agg(
        F.avg("mean").alias("batch_loss"), (F.sum("sum") / F.sum("n")).alias("row_loss")
    )


def repeat_run_stats(df: DataFrame, run: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: mean and population deviation of the accuracy over runs."""
    runs = df.groupBy(run).agg(F.avg(hit(label, prediction)).alias("a"))
    return runs.agg(F.avg("a").alias("mean_accuracy"), F.stddev_pop("a").alias("std_accuracy"))


def agreement_counts(aligned: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: rows where all predictions agree, and the rest; missing ones agree with each other."""
    first, *others = [F.col(c) for c in cols]
    same = F.lit(True)
    for c in others:
        same = same & c.eqNullSafe(first)
    return aligned.agg(F.count_if(same).alias("agree"), F.count_if(~same).alias("differ"))


def majority_vote(cols: Sequence[str]) -> Column:
    """The most common of the predictions; on a tie the one that comes first."""
    votes = F.array(*[F.col(c) for c in cols])
    counts = F.array(*[sum((F.col(a) == F.col(b)).cast("int") for b in cols) for a in cols])
    return V.let(counts, lambda n: F.element_at(votes, F.array_position(n, F.array_max(n)).cast("int")))
