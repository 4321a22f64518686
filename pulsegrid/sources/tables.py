"""Parquet tables of the test data layout: ``<sf_dir>/<name>.parquet``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan one table; selecting ``columns`` here lets the parquet reader prune."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def table_version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """The table's files by number and a sum of hashes of path, length and time; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(table_path(sf_dir, name))
    known = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum(known)).first())
