"""Feature assembly and standardisation (F1, F2; A2 via the scaler fit).

F1 + F2 form one ``Pipeline`` so a fitted preprocessing model can be saved,
loaded and applied as a unit.  The scaler is fitted on the training split by
default; ``fit_on="all"`` reproduces the original flow, whose statistics
include held-out rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "feature_vector"
SCALED = "scaled_feature_vector"


def assembler(cols: Sequence[str], output: str = FEATURES,
              handle_invalid: str = "error") -> VectorAssembler:
    """pack numeric columns into a dense vector.

    ``handle_invalid``: ``error`` (default, a NULL feature fails the job),
    ``skip`` (drop such rows) or ``keep`` (NaN in the vector).
    """
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid)


def scaler(input_col: str = FEATURES, output: str = SCALED) -> StandardScaler:
    """F2: ``(x - mean) / std_samp`` per element (constant elements give 0.0)."""
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=True, withStd=True)


def array_to_features(df: DataFrame, array_col: str, output: str = FEATURES) -> DataFrame:
    """Array column → ML dense vector column (no Python, a JVM expression)."""
    return df.withColumn(output, array_to_vector(F.col(array_col).cast("array<double>")))


def fit_preprocessing(train: DataFrame, cols: Sequence[str] | None = None,
                      handle_invalid: str = "error") -> PipelineModel:
    """F1 (if ``cols`` given) + F2 fitted on ``train``."""
    stages = ([assembler(cols, handle_invalid=handle_invalid)] if cols else []) + [scaler()]
    return Pipeline(stages=stages).fit(train)
