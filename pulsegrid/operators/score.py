"""Batch scoring with an externally trained model (M7, D7) and score columns.

``score_batches`` runs a NumPy predict function inside Spark tasks through
``predict_batch_udf``: Arrow batches of ``batch_size`` rows, and the model is
built once per Python worker (``make_predict_fn`` is called there, not on the
driver).  Sigmoid and half-even rounding are then plain JVM expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.scalar import rint, sigmoid


def linear_predict_fn(weights: Sequence[float], bias: float = 0.0) -> Callable[[], Callable]:
    """Factory for a NumPy linear scorer ``X @ w + b`` (logits), one per worker."""
    w = np.asarray(weights, dtype=np.float64)
    b = float(bias)

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            # (batch, width) → (batch,); a one-row batch stays 2-D on input.
            x2 = np.asarray(x, dtype=np.float64).reshape(-1, w.shape[0])
            return x2 @ w + b
        return predict

    return make


def save_linear_weights(path: str, weights: Sequence[float], bias: float = 0.0) -> None:
    """Write linear-model weights as ``.npz`` (``w``, ``b``) for ``npz_predict_fn``."""
    np.savez(path, w=np.asarray(weights, dtype=np.float64), b=np.float64(bias))


def npz_predict_fn(path: str) -> Callable[[], Callable]:
    """Factory for a linear scorer whose weights live in a file.

    Only the path travels with the task; each Python worker opens the file
    once, when Spark first calls the factory there, the way a trained
    checkpoint is loaded for inference.  ``path`` is either readable by every
    worker, or a bare file name shipped with ``SparkContext.addFile`` and
    resolved through ``SparkFiles.get``.
    """
    def make():
        import os

        local = path
        if os.sep not in path:
            from pyspark import SparkFiles

            local = SparkFiles.get(path)
        with np.load(local) as data:
            w = np.asarray(data["w"], dtype=np.float64)
            b = float(data["b"])

        def predict(x: np.ndarray) -> np.ndarray:
            return np.asarray(x, dtype=np.float64).reshape(-1, w.shape[0]) @ w + b
        return predict

    return make


def score_batches(df: DataFrame, input_col: str, make_predict_fn: Callable[[], Callable],
                  width: int, batch_size: int = 4096, output: str = "logit") -> DataFrame:
    """M7 + D7: apply a batch predict function to an ``array<double>`` column."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.DoubleType(),
                            batch_size=batch_size, input_tensor_shapes=[[width]])
    return df.withColumn(output, udf(F.col(input_col).cast("array<double>")))


def class_from_logit(logit: str | Column) -> tuple[Column, Column]:
    """X2 + X3: ``(probability, predicted class)`` = ``(sigmoid(z), rint(sigmoid(z)))``."""
    p = sigmoid(logit)
    return p, rint(p)


def lr_weights(lr_model) -> tuple[list[float], float]:
    """Coefficients of a fitted Spark LR model, for a NumPy scorer (bounded by width)."""
    return [float(v) for v in lr_model.coefficients.toArray()], float(lr_model.intercept)
