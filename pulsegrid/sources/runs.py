"""Logs that a repeated or broken run does not spoil.

Each run writes its own partition ``run_id=...`` of a log by dynamic partition
overwrite (staged by Spark, moved in place at commit), so the same run written twice
is there once.  A marker row (run, rows) follows under ``_commits``, which
readers of the log skip; ``read_runs`` returns only runs with a marker, so a run that
was lost between or during its writes is not visible, and writing it again completes it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run_id"


def _marker(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/_commits/{hashlib.sha256(run_id.encode()).hexdigest()[:32]}"


def write_run(df: DataFrame, path: str, run_id: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Write one run's rows; the same run written again replaces them."""
    spark = df.sparkSession
    out = (df.coalesce(1) if single_file else df).withColumn(RUN, F.lit(run_id))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN)
    (writer.option("header", "true") if fmt == "csv" else writer).format(fmt).save(path)
    marker = spark.range(1).select(F.lit(run_id).alias(RUN), F.current_timestamp().alias("at"))
    marker.coalesce(1).write.mode("overwrite").parquet(_marker(path, run_id))


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, at) of the runs that were written whole."""
    schema = T.StructType([T.StructField(RUN, T.StringType()), T.StructField("at", T.TimestampType())])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/_commits")


def read_runs(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Rows of all committed runs, with ``run_id`` as text; ``schema`` names the logged columns."""
    whole = T.StructType([f for f in schema.fields if f.name != RUN] + [T.StructField(RUN, T.StringType())])
    reader = spark.read.schema(whole).format(fmt)
    rows = (reader.option("header", "true") if fmt == "csv" else reader).load(path)
    return rows.join(committed_runs(spark, path).select(RUN), RUN, "left_semi").select(*whole.fieldNames())


def report_to_results(spark: SparkSession, report_path: str, results_path: str, run_id: str) -> None:
    """Re-read a text report and keep it in the results under its run, once."""
    lines = spark.read.text(report_path).withColumnRenamed("value", "line")
    write_run(lines, results_path, run_id, single_file=True)  # a few lines
