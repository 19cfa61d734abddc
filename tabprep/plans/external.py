"""Batch scoring by a model from outside Spark ML."""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tabprep.functions.vectors import argmax
from tabprep.session import address
from tabprep.sources.binary import file_system

#: Rows a model sees at once.
BATCH = 1024


def score(df: DataFrame, vector: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]], width: int, batch: int = BATCH) -> DataFrame:
    """Adds ``probs ARRAY<DOUBLE>`` and ``prediction INT``, the first of the largest probabilities.

    ``load`` gives the model, a function from a matrix of vectors to one of probabilities; it is called
    once per Python worker. All vectors have ``width`` entries and none is missing; others fail the job.
    """
    run = predict_batch_udf(load, return_type=ArrayType(DoubleType()), batch_size=batch, input_tensor_shapes=[[width]])
    scored = df.withColumn("probs", run(F.col(vector).cast("array<double>")))
    return scored.withColumn("prediction", argmax(F.col("probs")))


def save_weights(spark: SparkSession, path: str, **arrays: list) -> None:
    """Named arrays in one file of numpy's format; written by the driver, as a model is small."""
    content = io.BytesIO()
    np.savez(content, **{name: np.asarray(a, float) for name, a in arrays.items()})
    system, target = file_system(address(spark, path))
    system.create_dir(target.rpartition("/")[0], recursive=True)
    with system.open_output_stream(target, compression=None) as out:
        out.write(content.getvalue())


def perceptron(where: str) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Loads ``w1, b1, w2, b2`` of a net with one sigmoid layer and a softmax from a full address."""

    def load() -> Callable[[np.ndarray], np.ndarray]:
        system, path = file_system(where)
        with system.open_input_file(path) as f:
            found = np.load(io.BytesIO(f.read()))
            w1, b1, w2, b2 = (found[name] for name in ("w1", "b1", "w2", "b2"))

        def predict(x: np.ndarray) -> np.ndarray:
            z = 1 / (1 + np.exp(-(x @ w1.T + b1))) @ w2.T + b2
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return e / e.sum(axis=1, keepdims=True)

        return predict

    return load
