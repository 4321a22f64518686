"""Sinks: append-only logs, run-time rows, text reports and saved models.

Everything is a DataFrame write (S4-S7) or Spark ML persistence (S9), so the
output lands in whatever shared filesystem the path names.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def append_log(df: DataFrame, path: str, run_id: str | None = None,
               fmt: str = "csv", single_file: bool = False) -> None:
    """Append rows to a log folder, one sub-folder per run id.

    ``single_file`` writes one file per append through one task; use it only
    for small tables (a training log, a run-time row).
    """
    from pyspark.sql import functions as F

    out = df if run_id is None else df.withColumn("run_id", F.lit(run_id))
    writer = (out.coalesce(1) if single_file else out).write.mode("append")
    if run_id is not None:
        writer = writer.partitionBy("run_id")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


def write_report(lines: DataFrame, path: str, column: str = "line") -> None:
    """Overwrite a text report (one line per row, in ``order`` if present).

    A report is a few lines per model and split, so it is written as one
    ordered file.
    """
    ordered = lines.orderBy("order") if "order" in lines.columns else lines
    ordered.select(column).coalesce(1).write.mode("overwrite").text(path)


def append_report_csv(spark, report_path: str, results_path: str, run_id: str) -> None:
    """Re-read a text report and append it to a results CSV under ``run_id``."""
    from pyspark.sql import functions as F

    lines = spark.read.text(report_path).withColumnRenamed("value", "line")
    (lines.withColumn("run_id", F.lit(run_id)).coalesce(1)
     .write.mode("append").option("header", "true").csv(results_path))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)
