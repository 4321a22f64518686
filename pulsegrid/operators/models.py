"""Model fitters, multi-model scoring and objective curves (M1-M5).

Fitting is Spark ML: each iteration broadcasts the coefficients and
tree-aggregates gradients (LR, SVC) or split statistics (RF) across the
partitions of the training set, which should be persisted first.  Each model
writes its own output columns, so several models can score a table in a
single pass (see ``score_all``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.features import SCALED

LOGISTIC = "logistic_regression"
FOREST = "random_forest"
SVC = "linear_svc"
MODEL_NAMES = (LOGISTIC, FOREST, SVC)
_SHORT = {LOGISTIC: "lr", FOREST: "rf", SVC: "svc"}


def prediction_column(model_name: str) -> str:
    return f"prediction_{_SHORT.get(model_name, model_name)}"


def raw_column(model_name: str) -> str:
    return f"raw_{_SHORT.get(model_name, model_name)}"


def probability_column(model_name: str) -> str:
    return f"probability_{_SHORT.get(model_name, model_name)}"


@dataclass
class ModelSettings:
    """Fitter settings.

    Fixed values from the original flow: 12 trees with ``sqrt`` features per
    node for the forest.  Everything else is Spark's default (LR: 100
    iterations, tol 1e-6; forest depth 5; SVC: 100 iterations, no
    regularisation); the forest seed is explicit so runs repeat.
    """

    lr_max_iter: int = 100
    lr_tol: float = 1e-6
    rf_num_trees: int = 12
    rf_subset: str = "sqrt"
    rf_max_depth: int = 5
    rf_seed: int = 12345
    svc_max_iter: int = 100
    svc_reg: float = 0.0


def logistic(features: str = SCALED, label: str = "label", settings: ModelSettings = ModelSettings(),
             name: str = LOGISTIC) -> LogisticRegression:
    """M1: binary logistic regression (regParam 0, standardization on)."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=settings.lr_max_iter,
                              tol=settings.lr_tol, predictionCol=prediction_column(name),
                              rawPredictionCol=raw_column(name),
                              probabilityCol=probability_column(name))


def forest(features: str = SCALED, label: str = "label", settings: ModelSettings = ModelSettings(),
           name: str = FOREST) -> RandomForestClassifier:
    """M2: random forest, 12 trees, sqrt features per node, explicit seed."""
    return RandomForestClassifier(featuresCol=features, labelCol=label,
                                  numTrees=settings.rf_num_trees,
                                  featureSubsetStrategy=settings.rf_subset,
                                  maxDepth=settings.rf_max_depth, seed=settings.rf_seed,
                                  predictionCol=prediction_column(name),
                                  rawPredictionCol=raw_column(name),
                                  probabilityCol=probability_column(name))


def linear_svc(features: str = SCALED, label: str = "label", settings: ModelSettings = ModelSettings(),
               name: str = SVC) -> LinearSVC:
    """M3: linear support-vector classifier (hinge loss, OWL-QN)."""
    return LinearSVC(featuresCol=features, labelCol=label, maxIter=settings.svc_max_iter,
                     regParam=settings.svc_reg, predictionCol=prediction_column(name),
                     rawPredictionCol=raw_column(name))


_BUILDERS = {LOGISTIC: logistic, FOREST: forest, SVC: linear_svc}


def fit_model(name: str, train: DataFrame, features: str = SCALED, label: str = "label",
              settings: ModelSettings = ModelSettings()):
    """Fit one of ``MODEL_NAMES`` on ``train`` (persist ``train`` beforehand)."""
    return _BUILDERS[name](features, label, settings, name).fit(train)


def score_all(df: DataFrame, models: dict, label: str = "label", details: bool = False) -> DataFrame:
    """M4 for several models in one pass: ``(…, model, prediction)`` per model.

    ``details`` adds ``raw_prediction`` and ``probability`` as arrays (a model
    without probabilities, like the SVC, has NULL there).

    Each model appends its own columns; ``stack`` then turns the per-model
    prediction columns into rows.  The scored table is scanned once, not once
    per model and split.
    """
    scored = df
    for model in models.values():
        scored = model.transform(scored)
    names = list(models)
    parts = ", ".join(f"'{n}', cast({prediction_column(n)} as double)" for n in names)
    keep = [f"`{c}`" for c in df.columns]
    if not details:
        return scored.selectExpr(*keep, f"stack({len(names)}, {parts}) as (model, prediction)")
    arrays = {}
    for n in names:
        for c in (raw_column(n), probability_column(n)):
            arrays[c] = vector_to_array(c).cast("array<double>") if c in scored.columns else F.lit(None).cast("array<double>")
    parts = ", ".join(f"'{n}', cast({prediction_column(n)} as double), {raw_column(n)}, {probability_column(n)}" for n in names)
    return scored.withColumns(arrays).selectExpr(
        *keep, f"stack({len(names)}, {parts}) as (model, prediction, raw_prediction, probability)")


def objective_history(spark: SparkSession, models: dict) -> DataFrame:
    """``(model, iteration, objective)`` for models that record one.

    Random forests record no objective curve, so they contribute no rows.
    The curve has one value per optimizer iteration (bounded by ``maxIter``).
    """
    rows = []
    for name, model in models.items():
        if name == FOREST or not hasattr(model, "summary"):
            continue
        summary = model.summary() if callable(model.summary) else model.summary
        history = list(getattr(summary, "objectiveHistory", []) or [])
        rows += [(name, i, float(v)) for i, v in enumerate(history)]
    schema = T.StructType([T.StructField("model", T.StringType()),
                           T.StructField("iteration", T.IntegerType()),
                           T.StructField("objective", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def root_split(tree_model) -> tuple[int, float] | None:
    """``(feature index, threshold)`` of the first tree's root, from the public debug string."""
    import re

    text = tree_model.toDebugString
    m = re.search(r"If \(feature (\d+) <= ([-0-9.eE]+)\)", text)
    return (int(m.group(1)), float(m.group(2))) if m else None


def probability_of_one(col: str) -> Column:
    """Second element of a probability vector as a double."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(col))[1]


#: How many equal rows a weighted row stands for.
ROW_WEIGHT = "row_weight"


def weighted_rows(df: DataFrame, features: str = SCALED, label: str = "label") -> DataFrame:
    """M3: one row per distinct (features, label) with the number of rows it stands for.

    One partial aggregate; no row is left out, and a mean of losses weighted by
    ``ROW_WEIGHT`` is the mean over all rows, so a fit has the same objective
    whatever the number of rows behind each point.
    """
    grouped = df.groupBy(vector_to_array(features).alias("_pg_x"), F.col(label)).agg(F.count(F.lit(1)).cast("double").alias(ROW_WEIGHT))
    return grouped.select(array_to_vector("_pg_x").alias(features), label, ROW_WEIGHT)


def fit_svc_weighted(df: DataFrame, features: str = SCALED, label: str = "label", settings: ModelSettings = ModelSettings(),
                     name: str = SVC, tol: float = 1e-3, partitions: int | None = None):
    """M3 on weighted rows, ended when the objective settles.

    On rows that a plane separates the hinge loss keeps falling ever more slowly as the
    plane's weights grow, and OWL-QN breaks off in failed line searches.  The fit
    ends before that: as soon as the objective changes by less than ``tol`` of
    itself over the optimizer's window.  ``partitions`` spreads the weighted rows, if there are many.
    """
    rows = weighted_rows(df, features, label)
    rows = persist_for_iterations(rows.coalesce(partitions) if partitions else rows)
    try:
        return linear_svc(features, label, settings, name).setWeightCol(ROW_WEIGHT).setTol(tol).fit(rows)
    finally:
        rows.unpersist()


def persist_for_iterations(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Persist a training set for iterative fitters.

    Each optimizer iteration is one job over the partitions of the training
    set.  ``partitions`` spreads rows that sit in too few of them, by content;
    it is the caller's choice and never follows the row count, so the same
    call fits the same rows in the same layout on any cluster.
    """
    from pyspark import StorageLevel

    if partitions:
        df = df.repartition(partitions, *df.columns)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
