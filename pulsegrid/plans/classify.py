"""The classification flow: balance, split, standardise, fit, score, evaluate.

``classification_grid`` is the Spark-first form of the original script:

* one filter balances the classes (D5) instead of two scans, a split and a union;
* one hash expression tags train/test/validation (D2) without ``randomSplit``'s
  per-partition sort, and identically under any partitioning;
* the scaler is fitted on the training split (``fit_on="all"`` for the old
  behaviour) and applied in the same projection as the split tag;
* the training split is persisted once for the iterative fitters, then released;
* all models score the held-out rows in one pass, and one ``groupBy(model,
  split)`` yields every confusion count and rate (E8), instead of 30 count jobs.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.evaluate import metric_grid
from pulsegrid.operators.features import FEATURES, SCALED, array_to_features, fit_preprocessing
from pulsegrid.operators.models import (
    MODEL_NAMES,
    ModelSettings,
    fit_model,
    persist_for_iterations,
    score_all,
)
from pulsegrid.operators.split import GROUP, balance, balancing_fractions, with_split
from pulsegrid.sources.tables import read_table

SPLITS = ("train", "test", "validation")
TIMING_SCHEMA = T.StructType([T.StructField("model", T.StringType()),
                              T.StructField("stage", T.StringType()),
                              T.StructField("seconds", T.DoubleType())])


@dataclass
class GridResult:
    metrics: DataFrame
    timings: DataFrame
    models: dict = field(default_factory=dict)
    preprocessing: PipelineModel | None = None
    held_out: DataFrame | None = None   # scaled evaluation rows (lazy)


def embeddings_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide signal rows from ``embeddings``: ``(vec_id, x, label)``, label = ``label < 5``."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("x"),
                      (F.col("label") < 5).cast("double").alias("label"))


def prepare(df: DataFrame, key: str | Sequence[str], features: str | Sequence[str],
            label: str = "label", seed: int = 22,
            weights: Sequence[float] = (0.7, 0.2, 0.1), split_names: Sequence[str] = SPLITS,
            balance_fractions: Mapping[float, float] | None = None, balance_seed: int = 1000,
            fit_on: str = "train", split_rows: Sequence[str] | None = GROUP) -> tuple[DataFrame, PipelineModel]:
    """Balance (D5), tag splits (D2), assemble (F1) and standardise (F2).

    Returns ``(scaled, preprocessing)``; ``scaled`` has key, label, split and
    the scaled feature vector.  ``key`` names a row; for a key of several rows
    pass ``split_rows`` (see ``operators.split``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if balance_fractions:
        df = balance(df, balance_fractions, balance_seed, keys, label, split_rows)
    tagged = with_split(df, weights, split_names, seed, keys, rows=split_rows)
    if isinstance(features, str):
        tagged = array_to_features(tagged, features, FEATURES)
        cols = None
    else:
        cols = list(features)
    fit_rows = tagged if fit_on == "all" else tagged.filter(F.col("split") == split_names[0])
    pre = fit_preprocessing(fit_rows, cols)
    scaled = pre.transform(tagged).select(*keys, F.col(label).cast("double").alias(label),
                                          "split", SCALED)
    return scaled, pre


def classification_grid(df: DataFrame, key: str | Sequence[str], features: str | Sequence[str],
                        label: str = "label", seed: int = 22,
                        weights: Sequence[float] = (0.7, 0.2, 0.1),
                        models: Sequence[str] = MODEL_NAMES,
                        settings: ModelSettings = ModelSettings(),
                        balance_fractions: Mapping[float, float] | None = None,
                        balance_seed: int = 1000, fit_on: str = "train",
                        eval_splits: Sequence[str] = ("test", "validation"),
                        materialize_metrics: bool = True,
                        fit_parallelism: int = 1,
                        split_rows: Sequence[str] | None = GROUP) -> GridResult:
    """Fit ``models`` on the train split and evaluate them on ``eval_splits``.

    The fits are independent: with ``fit_parallelism > 1`` up to that many run
    as concurrent Spark jobs from a thread pool (as ``CrossValidator
    (parallelism=...)`` does), each reading the same persisted training split.
    The default fits one model after another, so each model's time is its own
    (E9); ``fit_all`` is the wall time of all fits either way.
    """
    spark = df.sparkSession
    t_all = time.perf_counter()
    keys = [key] if isinstance(key, str) else list(key)
    if balance_fractions:
        df = balance(df, balance_fractions, balance_seed, keys, label, split_rows)
    tagged = with_split(df, weights, SPLITS, seed, keys, rows=split_rows)
    if isinstance(features, str):
        tagged = array_to_features(tagged, features, FEATURES)
        cols, raw = None, [FEATURES]
    else:
        cols, raw = list(features), list(features)
    base = tagged.select(*keys, F.col(label).cast("double").alias(label), "split", *raw)
    # The raw training split is read once and cached; the scaler is fitted
    # from the cache and the fitters see its scaled view (each caches its own
    # blocks), so the source is not read again until evaluation.
    train_raw = persist_for_iterations(base.filter(F.col("split") == SPLITS[0]))
    pre = fit_preprocessing(train_raw if fit_on == "train" else base, cols)
    train = pre.transform(train_raw).select(*keys, label, "split", SCALED)
    timings = [("all", "preprocess_fit", time.perf_counter() - t_all)]

    def fit_one(name):
        t0 = time.perf_counter()
        model = fit_model(name, train, SCALED, label, settings)
        return name, model, time.perf_counter() - t0

    fitted = {}
    t_fit = time.perf_counter()
    try:
        workers = max(1, min(fit_parallelism, len(models)))
        if workers == 1:
            results = [fit_one(name) for name in models]
        else:
            with ThreadPoolExecutor(max_workers=workers) as pool:
                results = list(pool.map(fit_one, models))
        for name, model, seconds in results:
            fitted[name] = model
            timings.append((name, "fit", seconds))
        timings.append(("all", "fit_all", time.perf_counter() - t_fit))
    finally:
        train_raw.unpersist()

    held_out = pre.transform(base.filter(F.col("split").isin(list(eval_splits)))).select(
        *keys, label, "split", SCALED)
    metrics = metric_grid(score_all(held_out, fitted, label), ("model", "split"), label)
    if materialize_metrics:
        t0 = time.perf_counter()
        metrics = metrics.persist()
        metrics.count()  # one row per model × split
        timings.append(("all", "score_evaluate", time.perf_counter() - t0))
    timings.append(("all", "total", time.perf_counter() - t_all))
    return GridResult(metrics, spark.createDataFrame(timings, TIMING_SCHEMA), fitted, pre, held_out)


FLAGSHIP_FIT_PARALLELISM = 1   # each model is timed alone


def flagship_result(spark: SparkSession, sf_dir: str,
                    settings: ModelSettings = ModelSettings()) -> GridResult:
    """The full flow on the embeddings (label ``label < 5``).

    The classes are balanced first (D5, fractions from one count aggregate),
    then LR, RF and SVC are fitted one after another and evaluated on test and
    validation.
    """
    signal = embeddings_signal(spark, sf_dir)
    return classification_grid(signal, "vec_id", "x", settings=settings,
                               balance_fractions=balancing_fractions(signal),
                               fit_parallelism=FLAGSHIP_FIT_PARALLELISM)


def flagship(spark: SparkSession, sf_dir: str, settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Metric grid of ``flagship_result`` (one row per model and split)."""
    return flagship_result(spark, sf_dir, settings).metrics


def classify_signal_csv(spark: SparkSession, path: str, n_features: int, label: str = "label",
                        seed: int = 22, balance_classes: bool = True,
                        settings: ModelSettings = ModelSettings(),
                        fit_parallelism: int = 1, parquet_path: str | None = None) -> GridResult:
    """The original end-to-end flow on a headerless signal CSV (S2 → D5 → D2 → F1/F2 → M1-M3 → E8).

    The CSV is parsed once into parquet (``parquet_path``, default a fresh
    folder below the checkpoint folder) together with a content-hash row key
    (the file has none); every later pass reads the parquet.  Classes are
    balanced with fractions from one count aggregate, and the features are
    the positional columns ``_c0 .. _c{n-1}``.
    """
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.csv import signal_csv_to_parquet

    out = parquet_path or scratch_path(spark, "signal-parquet")
    keyed = signal_csv_to_parquet(spark, path, out, n_features, label, key="row_key")
    fractions = balancing_fractions(keyed, label) if balance_classes else None
    feats = [f"_c{i}" for i in range(n_features)]
    return classification_grid(keyed, "row_key", feats, label, seed, settings=settings,
                               balance_fractions=fractions, fit_parallelism=fit_parallelism)
