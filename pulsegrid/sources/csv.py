"""Signal CSV readers (S1, S2) and the header CSV log reader (S3).

A signal file has no header; every column is a number and the last one is the
class.  Reading with an explicit all-double schema (S2) avoids the extra pass
that ``inferSchema`` costs (S1 keeps it for files of unknown width).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.columns import rename_last


def signal_schema(n_features: int, label: str = "label") -> T.StructType:
    """``_c0 .. _c{n-1}`` double features plus a double label column."""
    fields = [T.StructField(f"_c{i}", T.DoubleType(), True) for i in range(n_features)]
    fields.append(T.StructField(label, T.DoubleType(), True))
    return T.StructType(fields)


def read_signal_csv(spark: SparkSession, path: str, n_features: int,
                    label: str = "label", mode: str = "FAILFAST") -> DataFrame:
    """Headerless numeric CSV, all doubles; a bad token fails the read."""
    return (spark.read.schema(signal_schema(n_features, label))
            .option("header", "false").option("mode", mode).csv(path))


class SignalCsvError(ValueError):
    """Lines that are no signal rows; ``lines`` has (file, line, text) of the first of them."""

    def __init__(self, lines: list[tuple[str, int, str]], total: int):
        self.lines, self.total = lines, total
        shown = "; ".join(f"{f}, line {n}: {t[:80]!r}" for f, n, t in lines)
        super().__init__(f"{total} lines are no signal rows: {shown}")


def bad_lines(spark: SparkSession, path: str, n_features: int, label: str = "label") -> DataFrame:
    """(file, line, text) of the lines that do not parse as a signal row; line numbers from 1.

    Lines are read as text and parsed one by one.  A line's number is its place in
    its block of the file (rows of one task keep their order) after the lines of the blocks
    before it; those are counted once per block, a table of one row per block.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    schema = T.StructType([*signal_schema(n_features, label).fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    wrong = lines.withColumn("p", parsed).where((F.trim("value") != "") & F.col("p._bad").isNotNull())
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("above"))
    placed = wrong.select("file", "block", "id", "value").join(starts, ["file", "block"])
    return placed.select("file", (F.col("above") + F.col("id") - F.col("first") + 1).alias("line"), F.col("value").alias("text"))


def read_signal_csv_located(spark: SparkSession, path: str, n_features: int, label: str = "label", shown: int = 20) -> DataFrame:
    """As ``read_signal_csv``, but bad tokens are named by file and line before the read fails."""
    bad = bad_lines(spark, path, n_features, label)
    total = bad.count()
    if total:
        first = bad.orderBy("file", "line").limit(shown).collect()
        raise SignalCsvError([(r["file"], r["line"], r["text"]) for r in first], total)
    return read_signal_csv(spark, path, n_features, label)


def read_signal_csv_inferred(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    """S1 + P1: headerless CSV with inferred types, last column renamed to ``label``."""
    df = spark.read.csv(path, header=False, inferSchema=True)
    return rename_last(df, label)


def read_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV with a header row (training-log read-back)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def signal_csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, n_features: int,
                          label: str = "label", key: str | None = "row_key") -> DataFrame:
    """Parse a signal CSV once and keep it as parquet (vectorised scans, pruning, pushdown).

    With ``key`` set, a content-hash row key (see ``content_key``) is computed
    once and stored with the rows.  Returns the parquet table.
    """
    from pulsegrid.operators.columns import content_key

    df = read_signal_csv(spark, csv_path, n_features, label)
    if key:
        df = content_key(df, key)
    df.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
