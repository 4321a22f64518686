"""Exact positions in a seeded shuffle order.

The shuffle order of a row is ``(md5('<seed>:<key>'), key)``; it does not
depend on partitioning, so the same seed gives the same permutation anywhere
(the DuckDB oracle reproduces it with ``row_number() over (order by md5, key)``).

Numbering is the distributed form of ``zipWithIndex`` after a global sort:

1. ``orderBy`` the shuffle key, extended by a content hash and a scan id so the
   full sort key is unique.  Spark range-partitions a sort from a sample, and a
   unique key lets it cut any run of equal keys (one key holding a third of the
   rows, or identical copies) across many partitions instead of one.
2. ``monotonically_increasing_id`` after the sort is ``(partition << 33) + i``:
   the id carries the row's place in the sorted order.  The sorted rows are
   written once as a parquet table below the shared checkpoint folder, which
   cuts the lineage (nothing upstream is recomputed after a lost executor)
   and fixes the ids, so the counting pass and the numbering pass see the
   same values.  The counting pass reads only the id column.
3. Row counts per sort partition (one row per partition) → prefix sums →
   broadcast back.  The broadcast table has exactly one row per sort
   partition, so its size is bounded by the number of sort partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_hex
from pulsegrid.session import scratch_path

_LOCAL_BITS = 33
# Largest offsets table (one row per sort partition, two longs) sent as a broadcast.
MAX_BROADCAST_PARTITIONS = 2_000_000


def sort_partition_bound(spark) -> int:
    """Upper bound on the partitions of a global sort: the shuffle partition setting.

    AQE may start from ``initialPartitionNum`` and only coalesces from there.
    """
    conf = spark.conf
    bound = int(conf.get("spark.sql.shuffle.partitions", "200"))
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if initial not in (None, "", "None"):
        bound = max(bound, int(initial))
    return bound


def shuffle_order(seed: int, key: str | Sequence[str]) -> list[Column]:
    """Sort columns that define the seeded permutation (D3)."""
    keys = [key] if isinstance(key, str) else list(key)
    return [hash_hex(seed, keys)] + [F.col(k) for k in keys]


def with_positions(df: DataFrame, order: Sequence[Column], column: str = "pos",
                   total_column: str | None = None) -> DataFrame:
    """Add a 0-based global position under ``order`` (exact, no single-task window).

    ``total_column`` also attaches the total row count (for positional cuts).
    """
    spark = df.sparkSession
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    staged = (df.withColumn("_pg_scan", F.monotonically_increasing_id())
              .withColumn("_pg_tie", content))
    ordered = staged.orderBy(*order, F.col("_pg_tie"), F.col("_pg_scan"))
    path = scratch_path(spark, "positions")
    (ordered.withColumn("_pg_mid", F.monotonically_increasing_id())
     .drop("_pg_scan", "_pg_tie")
     .write.mode("overwrite").parquet(path))
    numbered = spark.read.parquet(path)

    part = F.shiftright(F.col("_pg_mid"), _LOCAL_BITS)
    local = F.col("_pg_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = (numbered.select(part.alias("_pg_part"))
              .groupBy("_pg_part").agg(F.count(F.lit(1)).alias("_pg_n")))
    n_parts = sort_partition_bound(spark)
    # One row per sort partition: a bounded table, summed in one small task.
    w = Window.orderBy("_pg_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        "_pg_part",
        (F.sum("_pg_n").over(w) - F.col("_pg_n")).alias("_pg_off"),
        F.sum("_pg_n").over(Window.partitionBy(F.lit(1))).alias("_pg_total"),
    )
    # Broadcast only below a checked size (one row per sort partition, bounded
    # by the shuffle partition setting); past it, a plain (shuffle) join.
    side = F.broadcast(offsets) if n_parts <= MAX_BROADCAST_PARTITIONS else offsets
    out = (numbered.withColumn("_pg_part", part).withColumn("_pg_local", local)
           .join(side, "_pg_part")
           .withColumn(column, F.col("_pg_off") + F.col("_pg_local")))
    if total_column:
        out = out.withColumnRenamed("_pg_total", total_column)
    return out.drop("_pg_part", "_pg_local", "_pg_off", "_pg_mid", "_pg_total")


def exact_split(df: DataFrame, fraction: float, seed: int, key: str | Sequence[str],
                names: tuple[str, str] = ("train", "validation"),
                column: str = "split", position: str = "pos") -> DataFrame:
    """D3 + D4: shuffle by seeded hash, first ``floor(fraction * n)`` rows are ``names[0]``."""
    numbered = with_positions(df, shuffle_order(seed, key), position, total_column="_pg_n_all")
    cut = F.floor(F.col("_pg_n_all").cast("double") * F.lit(float(fraction)))
    return (numbered.withColumn(column, F.when(F.col(position) < cut, F.lit(names[0]))
                                .otherwise(F.lit(names[1])))
            .drop("_pg_n_all"))


def first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows under ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def every_kth(df: DataFrame, k: int, order: Sequence[Column], column: str = "pos",
              offset: int = 0) -> DataFrame:
    """Rows ``offset, offset+k, ...`` of the ordered table (``[offset::k]``)."""
    numbered = with_positions(df, order, column)
    return numbered.filter((F.col(column) >= offset) & (((F.col(column) - offset) % k) == 0))


def with_batches(df: DataFrame, batch_size: int, order: Sequence[Column],
                 column: str = "batch") -> DataFrame:
    """Fixed-size mini-batch ids (``pos div batch_size``) in the given order."""
    numbered = with_positions(df, order, "_pg_pos")
    return (numbered.withColumn(column, F.floor(F.col("_pg_pos") / F.lit(batch_size)).cast("bigint"))
            .drop("_pg_pos"))
