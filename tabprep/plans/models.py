"""Learners on Spark ML and batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import IDF, HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions import text as X
from tabprep.functions.vectors import argmax


def tree_fit(
    df: DataFrame, features: Sequence[str], label: str, max_depth: int = 30, max_bins: int = 256, seed: int = 42
) -> PipelineModel:
    """Gini tree. Thresholds are bin borders, so ``max_bins`` above the distinct values makes it exact."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="_x")
    tree = DecisionTreeClassifier(
        featuresCol="_x", labelCol=label, impurity="gini", maxDepth=max_depth, maxBins=max_bins, seed=seed
    )
    return Pipeline(stages=[assemble, tree]).fit(df)


def mlp_fit(
    df: DataFrame, features: Sequence[str], label: str, classes: int, hidden: int = 10, seed: int = 42, iterations: int = 100
) -> PipelineModel:
    """One hidden layer of sigmoids and a softmax output."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="_x")
    layers = [len(features), hidden, classes]
    net = MultilayerPerceptronClassifier(
        featuresCol="_x", labelCol=label, layers=layers, seed=seed, maxIter=iterations
    )
    return Pipeline(stages=[assemble, net]).fit(df)


def with_vector(df: DataFrame, array: str, out: str = "_x") -> DataFrame:
    """The Spark ML form of an ``ARRAY<DOUBLE>`` column."""
    return df.withColumn(out, array_to_vector(array))


def vector_classifier(
    df: DataFrame, dims: int, label: str, classes: int, hidden: int = 32, seed: int = 42, iterations: int = 60
) -> PipelineModel:
    """A dense head on fixed vectors (column ``_x``, see :func:`with_vector`)."""
    net = MultilayerPerceptronClassifier(
        featuresCol="_x", labelCol=label, layers=[dims, hidden, classes], seed=seed, maxIter=iterations
    )
    return Pipeline(stages=[net]).fit(df)


def pair_features(df: DataFrame, premise: str = "premise", hypothesis: str = "hypothesis") -> DataFrame:
    """Word lists of both sides, their overlap and their lengths."""
    both = df.withColumns({"_a": X.words(F.col(premise)), "_b": X.words(F.col(hypothesis))})
    shared, every = F.size(F.array_intersect("_a", "_b")), F.size(F.array_union("_a", "_b"))
    return both.withColumns(
        {
            "_overlap": F.coalesce(F.try_divide(shared, every), F.lit(0.0)),
            "_la": F.log1p(F.size("_a")),
            "_lb": F.log1p(F.size("_b")),
        }
    )


def pair_classifier(df: DataFrame, label: str = "label", buckets: int = 4096, iterations: int = 40) -> PipelineModel:
    """Text pair to class: hashed weighted words of both sides, overlap and lengths, logistic regression.

    Fit and apply on the output of :func:`pair_features`.
    """
    stages = []
    for side in ("_a", "_b"):
        stages.append(HashingTF(inputCol=side, outputCol=f"{side}_tf", numFeatures=buckets))
        stages.append(IDF(inputCol=f"{side}_tf", outputCol=f"{side}_idf"))
    inputs = ["_a_idf", "_b_idf", "_overlap", "_la", "_lb"]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_x"))
    stages.append(
        LogisticRegression(featuresCol="_x", labelCol=label, family="multinomial", regParam=0.01, maxIter=iterations)
    )
    return Pipeline(stages=stages).fit(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_batch(df: DataFrame, model: PipelineModel, keep: Sequence[str | Column]) -> DataFrame:
    """``(*keep, probs ARRAY<DOUBLE>, prediction INT)`` by a fitted model."""
    scored = model.transform(df).select(*keep, vector_to_array("probability").alias("probs"))
    return scored.withColumn("prediction", argmax(F.col("probs")))
