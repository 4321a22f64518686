"""Training-log filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.positions import every_kth


def finite(df: DataFrame, value: str) -> DataFrame:
    """Rows whose ``value`` is neither NULL nor NaN."""
    return df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value)))


def logged_points(log: DataFrame, x: str, value: str) -> DataFrame:
    """``(x, value)`` pairs where ``value`` was logged (the curve data, S10)."""
    return finite(log, value).select(x, value)


def every_kth_logged(log: DataFrame, order: str, value: str, k: int = 10) -> DataFrame:
    """P6 + P7: every ``k``-th logged value in ``order`` (``values[0::k]``)."""
    return every_kth(finite(log, value), k, [F.col(order)])
