"""Positional column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_last(df: DataFrame, name: str = "label") -> DataFrame:
    """Rename the last column."""
    return df.withColumnRenamed(df.columns[-1], name)


def feature_columns(df: DataFrame, label: str = "label",
                    exclude: Sequence[str] = ()) -> list[str]:
    """Every column but the label (and any excluded key columns)."""
    skip = {label, *exclude}
    return [c for c in df.columns if c not in skip]


def features_array(cols: Sequence[str], name: str = "x") -> Column:
    """Pack feature columns into one ``array<double>`` column."""
    return F.array(*[F.col(c).cast("double") for c in cols]).alias(name)


def append_label(features: str | Column, label: str | Column, name: str = "xy") -> Column:
    """Features array with the label appended as the last element."""
    f = F.col(features) if isinstance(features, str) else features
    y = F.col(label) if isinstance(label, str) else label
    return F.concat(f.cast("array<double>"), F.array(y.cast("double"))).alias(name)


def side_by_side(df: DataFrame, key: str | Sequence[str], label: str = "label",
                 prediction: str = "prediction") -> DataFrame:
    """``(key, actual, prediction)`` kept together by key, never by position."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, F.col(label).cast("double").alias("actual"),
                     F.col(prediction).cast("double").alias("prediction"))


def content_key(df: DataFrame, name: str = "row_key",
                cols: Sequence[str] | None = None) -> DataFrame:
    """Row key for tables without one (a headerless signal CSV): ``xxhash64`` of the row.

    Deterministic and independent of partitioning; identical rows share a key
    and so always land on the same side of a split.
    """
    use = list(cols) if cols else list(df.columns)
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in use]))
