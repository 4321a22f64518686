"""Jump consistent hashing of stable keys to shards, with gapless slots.

``shard_rows`` needs no ring table: a row's shard is a function of its key and
the shard count.  Going from n to n + 1 shards moves a row only into shard n,
and moves 1 / (n + 1) of the rows on average.  All work is done in JVM
expressions.

The jump recurrence multiplies modulo 2^64.  Spark's ANSI arithmetic raises on
overflow, so the state is kept as two 32-bit halves and the product is formed
from 16-bit limbs of the constant; every intermediate fits a signed long.

Edge cases: a NULL text counts as empty (8 bytes, CRC 0); a NULL key is hashed
like any other value; rows that are equal in all columns get different slots; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import written

# Fixed values of the published jump hash: its multiplier in 16-bit limbs, high to low.
_M_HIGH, _M1, _M0 = 2862933555777941757 >> 32, (2862933555777941757 >> 16) & 0xFFFF, 2862933555777941757 & 0xFFFF
_MASK = 0xFFFFFFFF


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a 64-bit key.

    Each round moves the candidate at least one shard on, so ``shards`` rounds
    are enough for every key; rounds after the end leave the state as it is.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_MASK).cast("long")).alias("lo"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
    )
    n = F.lit(shards).cast("long")

    def low(x: Column, bits: int) -> Column:
        return x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    def products(s: Column) -> Column:
        """key * multiplier + 1, in two steps so that no part is computed twice."""
        t0 = s.lo * F.lit(_M0).cast("long") + 1
        return F.struct(s.hi.alias("hi"), s.lo.alias("lo"), s.j.alias("j"), t0.alias("t0"),
                        (s.lo * F.lit(_M1).cast("long") + F.shiftright(t0, 16)).alias("t1"))

    def round_(s: Column, _: Column) -> Column:
        p = F.transform(F.array(products(s)), lambda p: F.struct(
            p.j.alias("b"),
            F.shiftleft(low(p.t1, 16), 16).bitwiseOR(low(p.t0, 16)).alias("lo"),
            low(F.shiftright(p.t1, 16) + p.lo * F.lit(_M_HIGH).cast("long") + p.hi * F.lit(_M0).cast("long")
                + F.shiftleft(low(p.hi * F.lit(_M1).cast("long"), 16), 16), 32).alias("hi")))
        moved = F.transform(p, lambda q: F.struct(
            q.hi.alias("hi"), q.lo.alias("lo"), q.b.alias("b"),
            F.floor((q.b + 1) * (F.lit(float(1 << 31)) / (F.shiftright(q.hi, 1) + 1).cast("double"))).cast("long").alias("j")))
        return F.when(s.j < n, moved[0]).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, round_, lambda s: s.b.cast("int"))


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``slot`` numbers the rows of a shard from 0 without gaps, in key order (ties
    by CRC, then size).  No shard is ever in one task: the narrow rows are
    range-sorted by (shard, key, ..., a row number), which splits equal keys
    too, and written; each sorted partition's first row and row count of every
    shard in it then give the offsets.  That table has at most (partitions +
    shards) rows, because a partition holds a contiguous range of shards.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = F.xxhash64(F.col(key))
    rows = docs.select(
        F.col(key), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_hash(hashed, shards).alias("shard"), jump_hash(hashed, shards + 1).alias("grown_shard"),
    )
    narrow = written(rows.withColumn("_tie", F.monotonically_increasing_id()), "shard-rows")
    order = ["shard", key, "text_crc32", "size", "_tie"]
    placed = (narrow.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    placed = written(placed, "shard-order")
    runs = placed.groupBy("_part", "shard").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_part", "shard", "_first", F.coalesce(before, F.lit(0)).cast("long").alias("_before"))
    return placed.join(F.broadcast(runs), ["_part", "shard"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_at") - F.col("_first")).alias("slot"), "grown_shard")
