"""Score arriving signal rows with fitted models and keep running confusion counts.

This is M4 + E1 of the batch flow applied to a file stream: new parquet files
in a folder are scored by the already-fitted models (a projection, no state)
and folded into ``count_if`` aggregates keyed by model.  The streaming state
is one row per model and split, so it stays bounded however long the stream
runs; the checkpoint goes to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.evaluate import confusion_counts, with_rates
from pulsegrid.operators.models import score_all
from pulsegrid.session import scratch_path


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None, table: str | None = None) -> DataFrame:
    """Parquet files arriving in the folder ``path``, or in its table ``table``.

    A table is a file ``<table>.parquet`` or a folder of that name with part files.

    By default each micro-batch takes every new file; ``max_files_per_trigger``
    caps a batch (for rate limiting a backfill).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if table:
        # A table that is one file lists itself; a folder lists what it holds, or nothing.
        at = f"{path.rstrip('/')}/{table}.parquet"
        listed = spark.read.format("binaryFile").load(at).select("path").head(1)
        if not (listed and listed[0]["path"].endswith(f"/{table}.parquet")):
            return reader.parquet(at)
        reader = reader.option("pathGlobFilter", f"{table}.parquet")
    return reader.parquet(path)


def running_confusion(stream: DataFrame, prepare, models: dict, label: str = "label",
                      by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Streaming E1-E6: ``prepare`` maps raw rows to scaled features (a fitted transform)."""
    scored = score_all(prepare(stream), models, label)
    return running_confusion_scored(scored, label, by)


def running_confusion_scored(scored: DataFrame, label: str = "label",
                             by: Sequence[str] = ("model", "split"),
                             prediction: str = "prediction") -> DataFrame:
    """Streaming E1-E6 over rows that already carry ``(…, model, prediction)``."""
    return with_rates(confusion_counts(scored, by, label, prediction))


def run_to_table(metrics: DataFrame, query_name: str, checkpoint: str | None = None) -> DataFrame:
    """Drive a streaming aggregate over all available input, return its result table.

    For bounded backfills and tests: the query processes every file present,
    stops, and the (small, one row per group) result is returned as a batch
    DataFrame.
    """
    query = start_running_confusion(metrics, query_name, checkpoint)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return metrics.sparkSession.table(query_name)


def start_running_confusion(metrics: DataFrame, query_name: str,
                            checkpoint: str | None = None,
                            table_path: str | None = None) -> StreamingQuery:
    """Run the aggregate in complete mode (state = one row per group).

    Without ``table_path`` the result is an in-memory table named
    ``query_name`` (small: one row per group).  With it, every micro-batch
    overwrites a parquet table there with the complete result (file sinks
    take no complete mode, ``foreachBatch`` does).
    """
    spark = metrics.sparkSession
    location = checkpoint or scratch_path(spark, f"stream-{query_name}")
    writer = (metrics.writeStream.outputMode("complete").queryName(query_name)
              .option("checkpointLocation", location))
    if table_path is None:
        return writer.format("memory").start()

    def overwrite(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)

    return writer.foreachBatch(overwrite).start()
