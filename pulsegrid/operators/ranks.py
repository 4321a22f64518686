"""Order statistics of the seeded shuffle order: exact cuts without a sort.

The order is that of ``positions``: ``md5('<seed>:<key>')``, then the key, then a
hash of the whole row.  To cut it at a rank nothing has to be sorted but the few
rows around the cut:

1. one map-side aggregate counts the rows under each 4-digit prefix of the md5
   (at most 65,536 rows, whatever the table holds) and names the prefix that the
   rank falls into;
2. as long as that prefix holds more than ``LEAF`` rows, the same is done below it
   with 4 more digits; a key that holds a large share of the rows has one md5,
   so its rows are told apart by the digits of the row hash in turn;
3. the at most ``LEAF`` distinct keys that are left are sorted on the driver.

The cut is the key of the row at that rank.  A split, a row range or a class of
exact size is then a filter that compares each row's own key with it: no exchange,
no sort, no written table, and the same rows under any layout or retry.  Only a
cut that falls among identical rows has more to do: such rows can't be told apart, so
they are counted and written out again, as many on each side as the rank says.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_hex
from pulsegrid.operators.positions import shuffle_order, with_positions

#: Keys that are sorted on the driver, and hex digits that one histogram tells apart.
LEAF, DIGITS = 10_000, 4
_MD5, _HASH = 32, 16
#: Identical rows that one task writes out again.
COPIES = 100_000


@dataclass(frozen=True)
class Cut:
    """A place in the order: before the row ``key``, after ``copies`` rows that have this very key.

    ``key`` is None at the ends: before all rows (``rank`` 0) or after them.
    """

    rank: int
    key: Row | None = None
    copies: int = 0


class SeededOrder:
    """The rows of ``df`` in the order of a seed and a key, cut at ranks."""

    def __init__(self, df: DataFrame, seed: int, key: str | Sequence[str]):
        self.df, self.seed = df, seed
        self.keys = [key] if isinstance(key, str) else list(key)
        self._top: list[tuple[str, int]] | None = None

    def row_key(self) -> Column:
        """(md5, key columns, row hash as hex digits in the order of the signed hash)."""
        content = F.xxhash64(*[F.col(f"`{c}`") for c in self.df.columns]).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
        return F.struct(hash_hex(self.seed, self.keys).alias("h"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(self.keys)],
                        F.lpad(F.hex(content), _HASH, "0").alias("t"))

    def _counts(self, rows: DataFrame, by: Column) -> list[tuple]:
        counted = rows.groupBy(by.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
        return sorted((r["d"], r["n"]) for r in counted)

    def _md5_counts(self, prefix: str) -> list[tuple[str, int]]:
        h = hash_hex(self.seed, self.keys)
        return self._counts(self.df.where(h.startswith(prefix)) if prefix else self.df, F.substring(h, 1, len(prefix) + DIGITS))

    def top(self) -> list[tuple[str, int]]:
        """Rows under each first prefix; counted once."""
        if self._top is None:
            self._top = self._md5_counts("")
        return self._top

    def total(self) -> int:
        return sum(n for _, n in self.top())

    def cut(self, rank: int) -> Cut:
        if rank <= 0:
            return Cut(0)
        if rank >= self.total():
            return Cut(self.total())
        left, (prefix, held) = _within(self.top(), rank)
        while held > LEAF and len(prefix) < _MD5:
            left, (prefix, held) = _within(self._md5_counts(prefix), left)
        rows = self.df.select(self.row_key().alias("k")).where(F.col("k.h").startswith(prefix))
        digits = ""
        if held > LEAF:
            # One md5.  Keys of one text (they differ in where a NULL stands) are few; then the row hash decides.
            names = [F.col(f"k.k{i}") for i in range(len(self.keys))]
            tuples = rows.groupBy(F.struct(*names).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()
            left, (chosen, held) = _within([(r["d"], r["n"]) for r in tuples], left)
            for c, v in zip(names, chosen, strict=True):
                rows = rows.where(c.eqNullSafe(F.lit(v)))
        while held > LEAF and len(digits) < _HASH:
            counts = self._counts(rows.where(F.col("k.t").startswith(digits)), F.substring("k.t", 1, len(digits) + DIGITS))
            left, (digits, held) = _within(counts, left)
        if digits:
            rows = rows.where(F.col("k.t").startswith(digits))
        near = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy("k").collect()
        left, (key, _) = _within([(r["k"], r["n"]) for r in near], left)
        return Cut(rank, key, left)

    def after(self, cut: Cut) -> Column:
        """True for the rows whose key is that of the cut or a later one."""
        if cut.key is None:
            return F.lit(cut.rank == 0)
        return self.row_key() >= self._literal(cut.key)

    def _literal(self, key: Row) -> Column:
        types = [self.df.schema[k].dataType for k in self.keys]
        parts = [F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(key[1:-1], types, strict=True))]
        return F.struct(F.lit(key[0]).alias("h"), *parts, F.lit(key[-1]).alias("t"))

    def _copies(self, cut: Cut, number: str) -> DataFrame:
        """The rows that have the cut's key, numbered among themselves and dealt out in blocks."""
        cols = [F.col(f"`{c}`") for c in self.df.columns]
        counted = self.df.where(self.row_key() == self._literal(cut.key)).groupBy(*cols).agg(F.count(F.lit(1)).alias("_pg_n"))
        # One row, but for two contents with one 64-bit hash.
        order = Window.orderBy(F.to_json(F.struct(*cols))).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counted.withColumn("_pg_end", F.sum("_pg_n").over(order))
        step = F.lit(COPIES).cast("long")
        blocks = placed.withColumn("_pg_from", F.explode(F.sequence(F.col("_pg_end") - F.col("_pg_n"), F.col("_pg_end") - 1, step)))
        last = F.least(F.col("_pg_from") + step, F.col("_pg_end")) - 1
        return blocks.repartition("_pg_from").withColumn(number, F.explode(F.sequence("_pg_from", last))).select(*cols, number)

    def sides(self, cuts: Sequence[Cut], names: Sequence[str], column: str) -> DataFrame:
        """All rows, ``column`` naming the piece between consecutive cuts that a row lies in (one name more than cuts)."""
        def side(at_or_after: Sequence[Column]) -> Column:
            return reduce(lambda label, x: F.when(x[0], F.lit(x[1])).otherwise(label), zip(at_or_after, names[1:], strict=True), F.lit(names[0]))

        inner: dict[Row, list[Cut]] = {}
        for cut in cuts:
            if cut.copies:
                inner.setdefault(cut.key, []).append(cut)
        plain = self.df.where(~reduce(Column.__or__, [self.row_key() == self._literal(k) for k in inner])) if inner else self.df
        out = plain.withColumn(column, side([self.after(c) for c in cuts]))
        for key, own in inner.items():
            number = "_pg_copy"
            rows = self._copies(own[0], number)
            # A copy lies after a cut of an earlier key, and after a cut of its own key from that many copies on.
            marks = [F.col(number) >= c.copies if c.key == key else self.after(c) for c in cuts]
            out = out.unionByName(rows.withColumn(column, side(marks)).drop(number))
        return out

    def between(self, lo: Cut, hi: Cut) -> DataFrame:
        """The rows of the ranks ``[lo, hi)``."""
        if hi.rank <= lo.rank:
            return self.df.where(F.lit(False))
        if not (lo.copies or hi.copies):
            return self.df.where(self.after(lo) & ~self.after(hi))
        return self.sides([lo, hi], ["before", "in", "after"], "_pg_side").where("_pg_side = 'in'").drop("_pg_side")


def _within(counts: Sequence[tuple], rank: int) -> tuple[int, tuple]:
    """The entry of ``counts`` that holds a rank, and the rank inside it."""
    for entry in counts:
        if rank < entry[1]:
            return rank, entry
        rank -= entry[1]
    raise ValueError("a rank beyond all rows")


def split_rank(n: int, fraction: float) -> int:
    """floor(fraction * n) in doubles, as the positional split cuts."""
    return math.floor(float(n) * float(fraction))


def rank_split(df: DataFrame, fraction: float, seed: int, key: str | Sequence[str],
               names: tuple[str, str] = ("train", "validation"), column: str = "split") -> DataFrame:
    """D3 + D4: the exact split, labels only: a filter, as cheap as a hash split.

    The same labels as ``positions.exact_split``, which also numbers all rows.
    """
    order = SeededOrder(df, seed, key)
    return order.sides([order.cut(split_rank(order.total(), fraction))], names, column)


def row_range(df: DataFrame, start: int, stop: int, seed: int, key: str | Sequence[str], position: str = "pos") -> DataFrame:
    """The rows of the positions ``[start, stop)`` in the seeded order, with their position.

    Rows outside the range are neither sorted nor written; a start or stop past the end is the end.
    """
    return range_of(SeededOrder(df, seed, key), start, stop, position)


def range_of(order: SeededOrder, start: int, stop: int, position: str = "pos") -> DataFrame:
    start, stop = max(0, start), min(stop, order.total())
    rows = order.between(order.cut(start), order.cut(stop))
    if stop - start <= LEAF:
        # So few rows that one task sorts them; no table is written.
        content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
        placed = F.row_number().over(Window.orderBy(*shuffle_order(order.seed, order.keys), content))
        return rows.withColumn(position, placed.cast("long") - 1 + F.lit(start).cast("long"))
    numbered = with_positions(rows, shuffle_order(order.seed, order.keys), position)
    return numbered.withColumn(position, F.col(position) + F.lit(start))


def exact_counts(df: DataFrame, counts: Mapping[float, int], seed: int, key: str | Sequence[str], label: str = "label") -> DataFrame:
    """The first so many rows of each named class in the seeded order; other classes, and rows without a label, stay whole."""
    named = F.coalesce(F.col(label).isin([float(v) for v in counts]), F.lit(False))
    out = df.where(~named)
    for value, n in counts.items():
        order = SeededOrder(df.where(F.col(label) == F.lit(float(value))), seed, key)
        out = out.unionByName(order.between(order.cut(0), order.cut(n)))
    return out


def balance_exact(df: DataFrame, seed: int, key: str | Sequence[str], label: str = "label",
                  positive: float = 1.0, negative: float = 0.0) -> DataFrame:
    """Both classes with the smaller one's exact number of rows, the larger one's first in the seeded order."""
    n = df.agg(F.count_if(F.col(label) == positive).alias("p"), F.count_if(F.col(label) == negative).alias("n")).first()
    least = min(n["p"], n["n"])
    larger = {v: least for v, held in ((positive, n["p"]), (negative, n["n"])) if held > least}
    return exact_counts(df, larger, seed, key, label)
