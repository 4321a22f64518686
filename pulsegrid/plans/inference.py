"""Inference flow: standardise, split exactly, score held-out rows in batches, compare.

Spark form of the original inference script:

1. z-score every element of the signal by its mean and population std over
   all rows (A3, X1) — one aggregate, ``width`` numbers to the driver;
2. seeded exact 70/30 split (D3, D4) by rank — no unseeded reshuffle, so the
   held-out rows never overlap the training rows of the same seed, and no row
   outside the range that is scored is sorted, written or standardised;
3. mean log loss of the first 64 rows in key order (D6, M8);
4. the first 50 validation rows scored in Arrow batches by a NumPy model
   (D6, M7), sigmoid and half-even rounding (X2, X3);
5. exact-match test (A5) and the side-by-side table (P9).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import affine_array
from pulsegrid.operators import evaluate as E
from pulsegrid.operators.columns import side_by_side
from pulsegrid.operators.positions import first_rows
from pulsegrid.operators.ranks import SeededOrder, range_of, split_rank
from pulsegrid.operators.score import class_from_logit, score_batches
from pulsegrid.operators.stats import element_stats
from pulsegrid.plans.classify import embeddings_signal


@dataclass
class InferenceResult:
    first_rows_loss: DataFrame     # (n, loss) over the first ``check_n`` rows
    predictions: DataFrame         # (vec_id, pos, actual, prediction, probability)
    match: DataFrame               # (all_equal, n)


def standardise_all_rows(signal: DataFrame, col: str = "x", out: str = "z") -> DataFrame:
    """X1 with NumPy semantics (population std) over every row; constant elements → NULL."""
    means, _, stds = element_stats(signal, col)
    return signal.withColumn(out, affine_array(col, means, stds))


def inference_flow(spark: SparkSession, sf_dir: str, make_predict_fn: Callable, seed: int,
                   fraction: float = 0.7, first_n: int = 50, check_n: int = 64,
                   batch_size: int = 4096) -> InferenceResult:
    signal = embeddings_signal(spark, sf_dir)
    means, _, stds = element_stats(signal, "x")
    width = len(means)

    def standardised(rows: DataFrame) -> DataFrame:
        return rows.withColumn("z", affine_array("x", means, stds)).drop("x")

    head = score_batches(standardised(first_rows(signal, check_n, [F.col("vec_id")])), "z", make_predict_fn,
                         width, batch_size, "logit")
    loss = E.mean_bce(head, "logit", "label")

    order = SeededOrder(signal, seed, "vec_id")
    start = split_rank(order.total(), fraction)
    val = standardised(range_of(order, start, start + first_n))
    scored = score_batches(val, "z", make_predict_fn, width, batch_size, "logit")
    p, cls = class_from_logit("logit")
    scored = scored.withColumn("probability", p).withColumn("prediction", cls)
    pairs = side_by_side(scored, ["vec_id", "pos", "probability"])
    return InferenceResult(loss, pairs, E.exact_match(pairs))
