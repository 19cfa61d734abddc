"""Orders, batches and folds over ordered logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions import vectors as V
from tabprep.functions.arrays import elements
from tabprep.operators.prefix import with_ordinal


def rank_scores(df: DataFrame, scores: str) -> DataFrame:
    """Per sample one row per class: ``rank`` from 1, ``class`` and ``score``, highest first."""
    keep = [c for c in df.columns if c != scores]
    exploded = elements(df, keep, V.ranked(F.col(scores)), "_s", "rank")
    return exploded.select(
        *keep, (F.col("rank") + 1).alias("rank"), F.col("_s.index").alias("class"), F.col("_s.score").alias("score")
    )


def top2(df: DataFrame, scores: str) -> DataFrame:
    """Add the highest and second score, ``first`` and ``second``, and their ``margin``."""
    best = F.slice(F.sort_array(F.col(scores), asc=False), 1, 2)
    added = df.withColumn("_b", best)
    return added.select(
        *df.columns,
        F.get("_b", F.lit(0)).alias("first"),
        F.get("_b", F.lit(1)).alias("second"),
        (F.get("_b", F.lit(0)) - F.get("_b", F.lit(1))).alias("margin"),
    )


def with_batch(df: DataFrame, *order: Column | str, size: int, drop_last: bool = False) -> DataFrame:
    """Add ``batch_id`` (from 0): ``size`` consecutive rows each, the partial last one optional."""
    numbered = with_ordinal(df, *order, name="_row")
    batched = numbered.withColumn("batch_id", F.floor((F.col("_row") - 1) / size))
    if drop_last:
        full = numbered.agg(F.floor(F.max("_row") / size)).scalar()
        batched = batched.filter(F.col("batch_id") < full)
    return batched.drop("_row")


def early_stop(
    log: DataFrame,
    run: str,
    epoch: str,
    metric: str,
    patience: int,
    delta: float,
    mode: str = "min",
    reset_counter: bool = True,
) -> DataFrame:
    """``(run, best, best_epoch, stop_epoch)`` of each run; ``stop_epoch`` is NULL if never stopped.

    A metric improves when it beats the best so far by more than ``delta``; the best moves
    only then, so this is a fold over the epochs of a run and not a running maximum.
    ``best_epoch`` is the epoch whose model state would be kept. The log holds one row per
    epoch, so a run's list is as long as its training.
    """
    sign = 1.0 if mode == "min" else -1.0
    steps = F.array_sort(
        F.collect_list(F.struct(F.col(epoch).cast("int").alias("e"), F.col(metric).cast("double").alias("m")))
    )
    start = F.struct(
        F.lit(None).cast("double").alias("best"),
        F.lit(None).cast("int").alias("best_epoch"),
        F.lit(0).alias("waited"),
        F.lit(None).cast("int").alias("stop_epoch"),
    )

    def step(s: Column, x: Column) -> Column:
        better = s["best"].isNull() | (sign * x["m"] < sign * s["best"] - delta)
        waited = F.when(better, F.lit(0) if reset_counter else s["waited"]).otherwise(s["waited"] + 1)
        moved = F.struct(
            F.when(better, x["m"]).otherwise(s["best"]).alias("best"),
            F.when(better, x["e"]).otherwise(s["best_epoch"]).alias("best_epoch"),
            waited.alias("waited"),
            F.when(~better & (waited >= patience), x["e"]).alias("stop_epoch"),
        )
        return F.when(s["stop_epoch"].isNotNull(), s).otherwise(moved)

    folded = log.groupBy(run).agg(F.aggregate(steps, start, step).alias("s"))
    return folded.select(run, "s.best", "s.best_epoch", "s.stop_epoch")
