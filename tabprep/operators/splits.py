"""Information-gain split search on continuous columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.prefix import BUCKET_ROWS, running_sums

MOST_CLASSES = 1000
GAIN_PLACES = 12  # gains are compared after rounding, so equal splits tie


def class_list(df: DataFrame, label: str = "label") -> list[int]:
    """The distinct labels that are not NULL, ascending: one driver value per class.

    Split search makes expressions per class, so more than ``MOST_CLASSES`` are refused.
    """
    found = df.select(label).filter(F.col(label).isNotNull()).distinct().orderBy(label).limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    return [r[0] for r in found]


def entropy_of(counts: Sequence[Column]) -> Column:
    """-sum p log2 p over class counts."""
    total = sum(counts[1:], counts[0])

    def term(c: Column) -> Column:
        p = c / total
        return F.when(c > 0, p * F.log2(p)).otherwise(F.lit(0.0))

    terms = [term(c) for c in counts]
    return -sum(terms[1:], terms[0])


def entropy(df: DataFrame, label: str = "label") -> DataFrame:
    """``entropy`` of the label column: one shuffle of class counts."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    # one row per class reaches this window
    share = F.col("c") / F.sum("c").over(Window.partitionBy(F.lit(1)))
    return counts.select(share.alias("p")).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def split_scan(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    classes: Sequence[int],
    by: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Every candidate split: ``(*by, feature_no, feature, threshold, gain, n, n_left)``.

    A candidate lies at the midpoint of two neighbouring distinct values. Rows are
    reduced to class counts per distinct value before anything is ordered; class counts
    left of a boundary are running sums, so a boundary costs one row, not a rescan. ``rows``
    is a known bound on the rows of ``df``. A missing (NULL or NaN) value of a feature counts
    for none of its splits; a row without a label counts nowhere.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("feature_no"), F.col(f).cast("double").alias("value"))
            for i, f in enumerate(features)
        ]
    )
    counted = (
        df.filter(F.col(label).isNotNull())
        .select(*by, F.col(label).alias("_y"), F.inline(pairs))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "feature_no", "value")
        .agg(*[F.count_if(F.col("_y") == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)])
    )
    sums = [f"c{i}" for i in range(len(classes))]
    ran = running_sums(counted, [*by, "feature_no"], "value", sums, bucket_rows, None if rows is None else rows * len(features))

    left = [F.col(f"{s}_run") for s in sums]
    both = [F.col(f"{s}_all") for s in sums]
    right = [a - b for a, b in zip(both, left)]
    n_left, n = sum(left[1:], left[0]), sum(both[1:], both[0])
    after = (n_left / n) * entropy_of(left) + ((n - n_left) / n) * entropy_of(right)
    names = F.array(*[F.lit(f) for f in features])
    return ran.filter(F.col("_next").isNotNull()).select(
        *by,
        "feature_no",
        F.element_at(names, F.col("feature_no") + 1).alias("feature"),
        ((F.col("value") + F.col("_next")) / 2).alias("threshold"),
        (F.round(entropy_of(both) - after, GAIN_PLACES) + F.lit(0.0)).alias("gain"),  # no -0.0
        n.alias("n"),
        n_left.alias("n_left"),
    )


def best_of(candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The candidate with the largest gain; ties go to the first feature, then the smallest threshold.

    ``max_by`` combines on the map side, so no group is gathered.
    """
    rank = F.struct("gain", -F.col("feature_no"), -F.col("threshold"))
    row = F.struct("feature_no", "feature", "threshold", "gain", "n", "n_left")
    best = candidates.groupBy(*by).agg(F.max_by(row, rank).alias("_b"))
    return best.filter(F.col("_b").isNotNull()).select(*by, "_b.*")


def best_split(df: DataFrame, feature: str, label: str, classes: Sequence[int]) -> DataFrame:
    """Best threshold of one column."""
    return best_of(split_scan(df, [feature], label, classes))


def best_feature(df: DataFrame, features: Sequence[str], label: str, classes: Sequence[int]) -> DataFrame:
    """Best (feature, threshold) over several columns."""
    return best_of(split_scan(df, features, label, classes))
