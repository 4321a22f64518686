"""Run report: text lines from the metric grid and timings.

The lines are built with Spark string functions from the grid (one row per
model and split) and the timing table; a ``position`` column keeps the
report order.  Writers: one overwritten text report (S6), one appended
run-time row (S5) and the report appended to a results CSV under a run id
(S7).  Both inputs are small aggregates, so the report is too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.evaluate import METRIC_COLUMNS
from pulsegrid.sources.sinks import append_log, append_report_csv, write_report

# Report labels.
MODEL_TITLES = {
    "logistic_regression": "Logistic Regression",
    "random_forest": "Random Forest",
    "linear_svc": "Support Vector Classifier",
}
SPLIT_TITLES = {"train": "Training", "test": "Test", "validation": "Validation"}
METRIC_TITLES = {
    "accuracy": "Overall Accuracy",
    "recall": "Recall (True Positive Rate)",
    "recall_compat": "Recall as first reported (tn / (tp + tn))",
    "specificity": "Specificity (True Negative Rate)",
    "precision": "Precision (Positive Prediction Value)",
    "neg_pred_val": "Negative Prediction Value",
}


def _title(col: str, titles: dict) -> F.Column:
    expr = F.col(col)
    mapping = F.create_map(*[F.lit(x) for kv in titles.items() for x in kv])
    return F.coalesce(mapping[expr], expr)


def _orders():
    model_order = F.create_map(*[F.lit(x) for i, m in enumerate(MODEL_TITLES) for x in (m, i)])
    split_order = F.create_map(*[F.lit(x) for i, s in enumerate(SPLIT_TITLES) for x in (s, i)])
    return model_order, split_order


def _timing_lines(timings: DataFrame) -> DataFrame:
    """Total time first, then one runtime line per fitted model."""
    model_order, _ = _orders()
    total = timings.filter((F.col("model") == "all") & (F.col("stage") == "fit_all")).select(
        F.lit(0).cast("bigint").alias("position"),
        F.format_string("Total time of training all models: %.4f seconds", "seconds").alias("line"))
    fits = timings.filter(F.col("stage") == "fit").select(
        (F.lit(1000) * (F.coalesce(model_order[F.col("model")], F.lit(99)) + 1)).cast("bigint")
        .alias("position"),
        F.format_string("%s Runtime: %.4f seconds", _title("model", MODEL_TITLES),
                        "seconds").alias("line"))
    return total.unionByName(fits)


def report_lines(metrics: DataFrame, timings: DataFrame | None = None) -> DataFrame:
    """``(position, line)``: total time, then per model its fit time and metrics per split.

    Without ``timings`` only the per-split headers and metric lines are made.
    """
    model_order, split_order = _orders()
    base = (F.lit(1000) * (F.coalesce(model_order[F.col("model")], F.lit(99)) + 1)
            + F.lit(100) * (F.coalesce(split_order[F.col("split")], F.lit(9)) + 1))
    headers = metrics.select(base.cast("bigint").alias("position"),
                             F.format_string("%s %s Results:", _title("model", MODEL_TITLES),
                                             _title("split", SPLIT_TITLES)).alias("line"))
    parts = ", ".join(f"{i + 1}, '{m}', {m}" for i, m in enumerate(METRIC_COLUMNS))
    long = metrics.select("model", "split", base.alias("base"), *METRIC_COLUMNS).selectExpr(
        "model", "split", "base",
        f"stack({len(METRIC_COLUMNS)}, {parts}) as (k, metric, value)")
    values = long.select(
        (F.col("base") + F.col("k")).cast("bigint").alias("position"),
        F.when(F.col("value").isNull(),
               F.format_string("%s: undefined (zero denominator)", _title("metric", METRIC_TITLES)))
        .otherwise(F.format_string("%s: %2.4f%%", _title("metric", METRIC_TITLES), F.col("value")))
        .alias("line"))
    lines = headers.unionByName(values)
    return lines if timings is None else _timing_lines(timings).unionByName(lines)


def write_run_report(spark, metrics: DataFrame, timings: DataFrame, report_path: str,
                     results_path: str, times_path: str, run_id: str) -> DataFrame:
    """S5 + S6 + S7: write the report, append the total time, append the report to results."""
    lines = report_lines(metrics, timings).withColumnRenamed("position", "order")
    write_report(lines, report_path)
    total = timings.filter((F.col("model") == "all") & (F.col("stage") == "fit_all")).select("seconds")
    append_log(total, times_path, run_id=run_id, single_file=True)  # one row
    append_report_csv(spark, report_path, results_path, run_id)
    return lines
