"""From a raw table with gaps to a scored submission, as one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators import clean, evaluate, sampling
from tabprep.plans import tree
from tabprep.session import cut


@dataclass(frozen=True)
class Preparation:
    """What is done to a table's columns: gaps filled by medians and modes, names replaced by codes, columns dropped."""

    medians: Sequence[str] = ()
    modes: Sequence[str] = ()
    codes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    drop: Sequence[str] = ()

    def __call__(self, df: DataFrame) -> DataFrame:
        """Each table is filled by its own medians and modes. A name without a code becomes NULL."""
        df = df.drop(*self.drop)
        for c in self.medians:
            df = clean.impute_median(df, c)
        for c in self.modes:
            df = clean.impute_mode(df, c)
        return df.withColumns({c: clean.map_categories(F.col(c), codes) for c, codes in self.codes.items()})


@dataclass(frozen=True)
class Outcome:
    """A fitted tree, the held-out rows with their predictions, and the submission ``(key, label)``."""

    nodes: DataFrame
    held_out: DataFrame
    submission: DataFrame

    def accuracy(self, label: str) -> DataFrame:
        return evaluate.accuracy(self.held_out, label)

    def report(self, label: str) -> DataFrame:
        return evaluate.classification_report(self.held_out, label)


def table_job(
    train: DataFrame, test: DataFrame, key: str, label: str, features: Sequence[str], prepare: Preparation, max_depth: int = 10, held_out: float = 0.2, seed: int = 42
) -> Outcome:
    """Prepare both tables, hold some rows of ``train`` back, grow the exact tree on the rest, and predict.

    Rows of ``train`` without a label train nothing and are no hits; ``test`` needs no label. Every row
    of ``test`` is in the submission, gaps and all: a missing feature goes right.
    """
    ready = cut(sampling.split_seeded(prepare(train), key, held_out, seed))
    nodes = cut(tree.id3_fit(ready.filter("part = 'train'"), features, label, max_depth))
    told = tree.id3_predict(ready.filter("part = 'test'").drop("part"), nodes, features, threshold_2dp=False)
    asked = tree.id3_predict(prepare(test), nodes, features, threshold_2dp=False)
    return Outcome(nodes, told, asked.select(key, F.col("prediction").alias(label)))
