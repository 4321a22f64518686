"""Label filters, hash splits, class balancing and union.

Splits are half-open ranges of ``hash_unit(seed, key)``: a split is a plain
filter, so it needs no shuffle and no sort (``randomSplit`` sorts every
partition on all columns first), and a row lands on the same side whatever the
partitioning.

``rows`` says what tells the rows of one key apart.  ``ROWS`` (the default)
hashes all other columns along with the key, so every row is dealt on its own
and a key that holds a large share of the rows spreads like any other.  A list
of columns does the same from those alone (integers and strings hash alike in
other engines).  ``GROUP`` hashes the key only: for keys that name one row, or
to keep a key's rows on one side.  Identical rows hash alike; ``numbered_copies``
tells them apart first.  NULL key parts are skipped by ``concat_ws``, so
NULL-keyed rows of a group split share one deterministic side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_unit

KeySpec = str | Column | Sequence[str | Column]

ROWS = None
GROUP: tuple[str, ...] = ()
_UNIT = "_pg_unit"


def row_unit(df: DataFrame, seed: int, key: KeySpec, rows: Sequence[str] | None = ROWS) -> Column:
    """``hash_unit`` of the key and of what tells its rows apart."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    if rows is None:
        others = sorted(c for c in df.columns if c not in keys)
        rows = [F.xxhash64(*[F.col(f"`{c}`") for c in others])] if others else []
    return hash_unit(seed, [*keys, *rows])


def numbered_copies(df: DataFrame, column: str = "copy", block: int = 100_000) -> DataFrame:
    """``df`` with an occurrence number (from 0) on identical rows.

    Copies are counted before the shuffle and written out again in blocks that
    are dealt out anew, so a row with very many copies is no single task's work.
    """
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_pg_n"))
    blocks = counted.withColumn("_pg_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pg_n") - 1, F.lit(block).cast("long"))))
    spread = blocks.repartition(*[F.col(f"`{c}`") for c in df.columns], F.col("_pg_from"))
    last = F.least(F.col("_pg_from") + block, F.col("_pg_n")) - 1
    return spread.withColumn(column, F.explode(F.sequence("_pg_from", last))).drop("_pg_n", "_pg_from")


def label_filter(df: DataFrame, value: float, label: str = "label") -> DataFrame:
    """Rows of one class (numeric comparison, no string literal)."""
    return df.filter(F.col(label) == F.lit(float(value)))


def split_bounds(weights: Sequence[float]) -> list[tuple[float, float]]:
    """Normalised cumulative ``[lo, hi)`` ranges for the given weights."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError(f"weights must be non-negative with a positive sum: {weights}")
    bounds, lo = [], 0.0
    for i, w in enumerate(weights):
        hi = 1.0 if i == len(weights) - 1 else lo + w / total
        bounds.append((lo, hi))
        lo = hi
    return bounds


def split_label(weights: Sequence[float], names: Sequence[str], unit: Column) -> Column:
    """Name of the split a row falls into (CASE over upper bounds of ``unit``)."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    expr = F
    for (lo, hi), name in zip(split_bounds(weights), names):
        if hi > lo:
            expr = expr.when(unit < F.lit(hi), F.lit(name))
    return expr


def hash_split(df: DataFrame, weights: Sequence[float], seed: int,
               key: KeySpec, rows: Sequence[str] | None = ROWS) -> list[DataFrame]:
    """``randomSplit``-like list of DataFrames, one filter each."""
    u = row_unit(df, seed, key, rows)
    return [df.filter((u >= F.lit(lo)) & (u < F.lit(hi))) for lo, hi in split_bounds(weights)]


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """D1/D2 with ``randomSplit`` semantics, for parity with existing results.

    Spark sorts every partition on all columns before sampling, and the rows
    chosen depend on the partition layout; prefer ``hash_split``.
    """
    return df.randomSplit(list(weights), seed=seed)


def with_split(df: DataFrame, weights: Sequence[float], names: Sequence[str],
               seed: int, key: KeySpec, column: str = "split",
               rows: Sequence[str] | None = ROWS) -> DataFrame:
    """Tag every row with its split name in one pass (no separate scans, one hash a row)."""
    united = df.withColumn(_UNIT, row_unit(df, seed, key, rows))
    return united.withColumn(column, split_label(weights, names, F.col(_UNIT))).drop(_UNIT)


def balance(df: DataFrame, fractions: Mapping[float, float], seed: int, key: KeySpec,
            label: str = "label", rows: Sequence[str] | None = ROWS) -> DataFrame:
    """Keep a hashed fraction of each class in one pass over the data.

    ``fractions`` maps class value → kept fraction (1.0 keeps the class whole;
    classes not named, and rows with a NULL label, are kept whole).  This is P4 + D1 + U1 of the original
    flow fused into one filter, so the input is scanned once.
    """
    if not fractions:
        return df
    kept = F
    for value, frac in fractions.items():
        kept = kept.when(F.col(label) == F.lit(float(value)), F.lit(float(frac)))
    return df.filter(row_unit(df, seed, key, rows) < kept.otherwise(F.lit(1.0)))


def balance_sample_by(df: DataFrame, fractions: Mapping[float, float], seed: int,
                      label: str = "label") -> DataFrame:
    """D5 with Spark's ``sampleBy`` (per-row Bernoulli draws), for parity runs.

    One pass like ``balance``, but which rows are kept depends on the
    partition layout; classes not named are dropped, as ``sampleBy`` does.
    """
    return df.sampleBy(label, {float(k): float(v) for k, v in fractions.items()}, seed)


def balancing_fractions(df: DataFrame, label: str = "label",
                        positive: float = 1.0, negative: float = 0.0) -> dict[float, float]:
    """Fraction of the larger class that makes both classes about equal.

    One aggregation; only two counts reach the driver.
    """
    row = df.agg(
        F.count_if(F.col(label) == F.lit(positive)).alias("p"),
        F.count_if(F.col(label) == F.lit(negative)).alias("n"),
    ).first()
    p, n = int(row["p"]), int(row["n"])
    if p == 0 or n == 0:
        return {positive: 1.0, negative: 1.0}
    if p > n:
        return {positive: n / p, negative: 1.0}
    return {positive: 1.0, negative: p / n}


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union that keeps duplicates and matches columns by name."""
    out = first
    for o in others:
        out = out.unionByName(o)
    return out
