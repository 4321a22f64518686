"""Column statistics (A2, A3, A6) and z-scoring by those statistics.

All statistics are one global aggregate (partial aggregation on every task,
one tiny final merge).  Only one row of numbers per feature ever reaches the
driver, so the size is bounded by the width, never by the row count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import zscore


# Up to this many columns the moments are one wide aggregate (fastest, fully
# code-generated); wider tables are unpivoted first, because a single
# aggregate with hundreds of moment functions compiles into methods too large
# for the JVM to JIT (measured: 140 columns, 85 s wide vs 27 s unpivoted).
WIDE_AGGREGATE_LIMIT = 8


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2 + A3 as a long table ``(feature, mean, std_samp, std_pop, n)``.

    One pass computes every column's moments.  Narrow tables use one wide
    aggregate and ``stack`` the single result row; wide tables ``stack`` the
    rows into ``(feature, value)`` and aggregate per feature, partially on
    every task, so only ``#features`` rows per task are shuffled.  Both
    paths use the same aggregate functions (NULLs skipped per column).
    """
    if len(cols) > WIDE_AGGREGATE_LIMIT:
        parts = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
        long = df.selectExpr(f"stack({len(cols)}, {parts}) as (feature, v)")
        found = long.groupBy("feature").agg(
            F.avg("v").alias("mean"), F.stddev_samp("v").alias("std_samp"),
            F.stddev_pop("v").alias("std_pop"), F.count(F.lit(1)).alias("n"))
        # Every feature has its row on an empty table too, as on the narrow path.
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
        return names.join(found, "feature", "left").fillna(0, ["n"])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.stddev_pop(x).alias(f"p{i}")]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    parts = ", ".join(f"'{c}', m{i}, s{i}, p{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) as (feature, mean, std_samp, std_pop)", "n")


def stats_dict(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Driver-side ``{feature: (mean, std_samp, std_pop)}`` (one row per feature)."""
    return {r["feature"]: (r["mean"], r["std_samp"], r["std_pop"])
            for r in column_stats(df, cols).collect()}


def zscore_columns(df: DataFrame, cols: Sequence[str], stats: dict | None = None,
                   ddof: int = 0, suffix: str = "") -> DataFrame:
    """X1 over every feature: ``(x - mean) / std``; NULL for constant columns.

    ``ddof=0`` is the population std (NumPy's ``np.std``), ``ddof=1`` the
    sample std (``StandardScaler``).  ``stats`` may come from a training split
    so held-out rows are scaled by training statistics only.
    """
    stats = stats if stats is not None else stats_dict(df, cols)
    out = []
    for c in cols:
        mean, s_samp, s_pop = stats[c]
        std = s_pop if ddof == 0 else s_samp
        expr = (F.lit(None).cast("double") if mean is None or std is None
                else zscore(F.col(c).cast("double"), F.lit(mean), F.lit(std)))
        out.append(expr.alias(c + suffix))
    keep = [F.col(c) for c in df.columns if c not in cols or suffix]
    return df.select(*keep, *out)


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)`` as a one-row DataFrame (count runs on Spark)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def vector_stats(df: DataFrame, vector_col: str) -> DataFrame:
    """A2 over a vector column: per-element mean and sample std (``Summarizer``)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    s = df.select(Summarizer.metrics("mean", "std").summary(F.col(vector_col)).alias("s"))
    arrays = s.select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("std"))
    return arrays.select(F.posexplode(F.arrays_zip("mean", "std")).alias("feature", "v")).select(
        "feature", F.col("v.mean").alias("mean"), F.col("v.std").alias("std_samp"))


def element_stats(df: DataFrame, col: str, width: int | None = None) -> tuple[list, list, list]:
    """Per-element mean, sample std and population std of an array column.

    One ``Summarizer`` aggregate over the column as an ML vector (a single
    aggregate function, partial per task, whatever the width); only
    ``3 × width`` numbers reach the driver.  The population std is derived
    from the sample variance: ``var_pop = var_samp · (n - 1) / n``.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    vec = array_to_vector(F.col(col).cast("array<double>"))
    row = df.select(Summarizer.metrics("mean", "variance", "count").summary(vec).alias("s")).first()
    s = row["s"]
    n = int(s["count"])
    means = [float(v) for v in s["mean"].toArray()]
    var = [float(v) for v in s["variance"].toArray()]
    if width is not None and width != len(means):
        raise ValueError(f"expected width {width}, got {len(means)}")
    samp = [math.sqrt(v) if n > 1 else None for v in var]
    pop = [math.sqrt(v * (n - 1) / n) if n > 0 else None for v in var]
    return means, samp, pop


#: Bits of one part of a number in the exact sums, and parts per number.
PART_BITS, PARTS = 22, 6


def _exact_sums(df: DataFrame, cols: Sequence[str], values: Mapping[str, Column], tops: Mapping[str, float]) -> dict[str, Fraction]:
    """Sums of columns of doubles, the same in any order and layout.

    Each value is cut into ``PARTS`` whole numbers of ``PART_BITS`` bits below the
    column's largest magnitude (rows whose bits reach below the last part are
    rounded there, each on its own).  Whole numbers of 22 bits add up exactly in a long for
    2^41 rows, so the order of the sums does not matter.
    """
    aggs, units = [], {}
    for i, c in enumerate(cols):
        unit = 2.0 ** (math.frexp(tops[c] or 1.0)[1])
        rest = values[c]
        for k in range(PARTS):
            unit /= 2.0**PART_BITS
            if unit < 2.0**-1000:
                break
            part = F.floor(rest / F.lit(unit))
            rest = rest - part.cast("double") * F.lit(unit)
            aggs.append(F.sum(part).alias(f"s{i}_{k}"))
            units[i, k] = unit
    row = df.agg(*aggs).first()
    return {c: sum((Fraction(units[i, k]) * (row[f"s{i}_{k}"] or 0) for k in range(PARTS) if (i, k) in units), Fraction(0)) for i, c in enumerate(cols)}


def exact_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None, float | None]]:
    """A2 + A3: ``{column: (mean, std_samp, std_pop)}``, bit for bit the same under any layout.

    Three aggregates of one row: counts and largest magnitudes, sums, and sums of squared
    deviations from the (rounded) mean.  NULLs are skipped; a column with a non-finite
    value has no finite moments and gives NaN, an empty one NULL.
    """
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    sizes = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(x.values())], *[F.max(F.abs(v)).alias(f"m{i}") for i, v in enumerate(x.values())]).first()
    n = {c: sizes[f"n{i}"] for i, c in enumerate(cols)}
    top = {c: sizes[f"m{i}"] for i, c in enumerate(cols)}
    good = [c for c in cols if n[c] and math.isfinite(top[c])]
    out: dict = {c: (None, None, None) if not n[c] else (math.nan,) * 3 for c in cols}
    if not good:
        return out
    sums = _exact_sums(df, good, x, top)
    mean = {c: float(sums[c] / n[c]) for c in good}
    off = {c: x[c] - F.lit(mean[c]) for c in good}
    squares = _exact_sums(df, good, {c: off[c] * off[c] for c in good}, {c: (2 * top[c]) ** 2 for c in good})
    for c in good:
        # Exact: the squares are taken from the rounded mean, which is off by a known amount.
        spread = squares[c] - n[c] * (Fraction(mean[c]) - sums[c] / n[c]) ** 2
        spread = max(spread, Fraction(0))
        out[c] = (mean[c], math.sqrt(spread / (n[c] - 1)) if n[c] > 1 else None, math.sqrt(spread / n[c]))
    return out
