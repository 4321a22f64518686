"""Evaluation operators.

The original flow ran five filter+count actions per model and split; here one
``groupBy(model, split)`` with ``count_if`` produces every cell for every model
and split in a single pass (partial aggregation per task, a tiny shuffle of
``#models × #splits`` rows).  Ratios use ``try_divide``: a zero denominator
gives NULL instead of an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import bce_with_logits, percent_of

METRIC_COLUMNS = ("accuracy", "recall", "recall_compat", "specificity", "precision", "neg_pred_val")


def _is(col: str, value: float) -> Column:
    return F.col(col) == F.lit(float(value))


def confusion_counts(scored: DataFrame, by: Sequence[str] = ("model", "split"),
                     label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1 (+ P5, A1): ``tp, tn, fp, fn, n`` per group; an empty cell is 0."""
    return scored.groupBy(*by).agg(
        F.count_if(_is(label, 1) & _is(prediction, 1)).alias("tp"),
        F.count_if(_is(label, 0) & _is(prediction, 0)).alias("tn"),
        F.count_if(_is(label, 0) & _is(prediction, 1)).alias("fp"),
        F.count_if(_is(label, 1) & _is(prediction, 0)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """E2-E6 from the counts, in percent.

    ``recall`` is the standard ``tp / (tp + fn)``; ``recall_compat`` keeps the
    figure the original report printed under that name, ``tn / (tp + tn)``.
    """
    tp, tn, fp, fn, n = (F.col(c) for c in ("tp", "tn", "fp", "fn", "n"))
    return counts.select(
        "*",
        percent_of(tp + tn, n).alias("accuracy"),
        percent_of(tp, tp + fn).alias("recall"),
        percent_of(tn, tp + tn).alias("recall_compat"),
        percent_of(tn, tn + fp).alias("specificity"),
        percent_of(tp, tp + fp).alias("precision"),
        percent_of(tn, tn + fn).alias("neg_pred_val"),
    )


def metric_grid(scored: DataFrame, by: Sequence[str] = ("model", "split"),
                label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts and rates for every model × split in one aggregation."""
    return with_rates(confusion_counts(scored, by, label, prediction))


def confusion_cells(counts: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """The 2×2 matrix as ``(…, actual, predicted, n)`` with zero cells kept."""
    keys = ", ".join(f"`{b}`" for b in by)
    return counts.selectExpr(
        *([keys] if by else []),
        "stack(4, 1.0D, 1.0D, tp, 0.0D, 1.0D, fp, 1.0D, 0.0D, fn, 0.0D, 0.0D, tn) "
        "as (actual, predicted, n)")


def matrix_rows(counts: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """E7 in the original layout ``[[tp, fp], [fn, tn]]``: rows ``Positive`` and ``Negative``.

    Columns ``first`` and ``second`` hold the two matrix columns of each row,
    the data behind the confusion-matrix plot (S10).
    """
    keys = [f"`{b}`" for b in by]
    return counts.selectExpr(
        *keys, "stack(2, 'Positive', tp, fp, 'Negative', fn, tn) as (row_label, first, second)")


def long_metrics(grid: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Metric record as a long table ``(…, metric, value)``."""
    parts = ", ".join(f"'{m}', {m}" for m in METRIC_COLUMNS)
    return grid.selectExpr(*[f"`{b}`" for b in by],
                           f"stack({len(METRIC_COLUMNS)}, {parts}) as (metric, value)")


def exact_match(df: DataFrame, actual: str = "actual", prediction: str = "prediction",
                by: Sequence[str] = ()) -> DataFrame:
    """A5: do two columns agree on every row (NULL-safe)?"""
    agg = F.bool_and(F.col(actual).eqNullSafe(F.col(prediction))).alias("all_equal")
    n = F.count(F.lit(1)).alias("n")
    return df.groupBy(*by).agg(agg, n) if by else df.agg(agg, n)


def mean_bce(df: DataFrame, logit: str | Column, label: str = "label",
             by: Sequence[str] = ()) -> DataFrame:
    """M8: mean binary cross-entropy on logits, optionally per group."""
    z = F.col(logit) if isinstance(logit, str) else logit
    loss = F.avg(bce_with_logits(z, F.col(label).cast("double"))).alias("loss")
    n = F.count(F.lit(1)).alias("n")
    return df.groupBy(*by).agg(loss, n) if by else df.agg(loss, n)


def mean_log_loss(df: DataFrame, p_one: str | Column, label: str = "label",
                  by: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """M8 for models that output a probability: mean ``-log p(true class)``."""
    p = F.col(p_one) if isinstance(p_one, str) else p_one
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    loss = F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("loss")
    return df.groupBy(*by).agg(loss) if by else df.agg(loss)
