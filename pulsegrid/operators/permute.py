"""Shuffles without a sort: a keyed permutation of row numbers.

``Permutation(n, seed)`` maps 0 .. n-1 one to one onto itself, row by row.  A number
is a place (l, r) in a grid of a x b >= n cells; each round adds a keyed hash of one
coordinate to the other, modulo its side, which can be undone, so the rounds are a
bijection of the grid.  A number that lands on a cell of n or more goes through
the rounds again until it lands below n (cycle walking), which keeps the map a
bijection of 0 .. n-1.  The sides are picked near the square root so that a x b - n is
small; the driver walks the few cells beyond n and so knows how many repeats the
longest walk takes; the expression has exactly these.

Rows are numbered once (in the order of their key, by one sort); after that every
epoch's shuffle is an expression over the number, for any number of epochs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.positions import with_positions

ROUNDS = 6
#: Sides that are tried, from the square root of n on.
SIDES = 1024
#: Hex digits of a round's hash.
_DIGITS = 12


def grid_sides(n: int) -> tuple[int, int]:
    """(a, b): the first a from the square root on, of ``SIDES``, with the fewest cells beyond n."""
    root = math.isqrt(max(n - 1, 0)) + 1
    return min(((a, -(-n // a)) for a in range(root, root + SIDES)), key=lambda s: (s[0] * s[1] - n, s[0]))


class Permutation:
    """A bijection of 0 .. n-1 that the seed chooses."""

    def __init__(self, n: int, seed: int | str):
        self.n, self.seed = n, str(seed)
        self.a, self.b = grid_sides(n)
        self.walks = self._longest_walk()

    def _hash(self, i: int, x: int) -> int:
        return int(hashlib.md5(f"{self.seed}:{i}:{x}".encode()).hexdigest()[:_DIGITS], 16)

    def _rounds(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS):
            if i % 2:
                right = (right + self._hash(i, left)) % self.b
            else:
                left = (left + self._hash(i, right)) % self.a
        return left * self.b + right

    def _longest_walk(self) -> int:
        """Most cells of n or more that a walk passes; each is met once, as the rounds are a bijection."""
        seen: dict[int, int] = {}

        for cell in range(self.n, self.a * self.b):
            path = []
            while cell >= self.n and cell not in seen:
                seen[cell] = 0
                path.append(cell)
                cell = self._rounds(cell)
            rest = seen.get(cell, 0) if cell >= self.n else 0
            for c in reversed(path):
                rest += 1
                seen[c] = rest
        return max(seen.values(), default=0)

    def of(self, x: int) -> int:
        """The place of a single number, as the expression gives it."""
        x = self._rounds(x)
        while x >= self.n:
            x = self._rounds(x)
        return x

    def _column_rounds(self, x: Column) -> Column:
        state = F.struct(F.floor(x / F.lit(self.b)).cast("long").alias("l"), (x % F.lit(self.b)).cast("long").alias("r"))

        def hashed(i: Column, y: Column) -> Column:
            text = F.concat_ws(":", F.lit(self.seed), i.cast("string"), y.cast("string"))
            return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long")

        def step(s: Column, i: Column) -> Column:
            left = F.when(i % 2 == 0, (s.l + hashed(i, s.r)) % self.a).otherwise(s.l)
            right = F.when(i % 2 == 1, (s.r + hashed(i, s.l)) % self.b).otherwise(s.r)
            return F.struct(left.alias("l"), right.alias("r"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, step, lambda s: s.l * F.lit(self.b) + s.r)

    def column(self, x: str | Column) -> Column:
        """The place of each number of a column; a number outside 0 .. n-1 is an input error."""
        x = (F.col(x) if isinstance(x, str) else x).cast("long")
        if not self.n:
            return x
        first = self._column_rounds(x)
        if not self.walks:
            return first
        again = lambda v, _: F.when(v >= self.n, self._column_rounds(v)).otherwise(v)
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.walks)), first, again)


def numbered_rows(df: DataFrame, key: str | Sequence[str], column: str = "row") -> tuple[DataFrame, int]:
    """``df`` with dense row numbers in the order of its key (written once), and the number of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    out = with_positions(df, [F.col(f"`{k}`") for k in keys], column)
    return out, out.select(column).count()


def permuted(df: DataFrame, n: int, seed: int | str, row: str = "row", column: str = "pos") -> DataFrame:
    """D3: the seeded shuffle of rows that are numbered 0 .. n-1, without a sort."""
    return df.withColumn(column, Permutation(n, seed).column(row))


def epoch_batches(df: DataFrame, n: int, batch_size: int, epochs: Sequence[int], seed: int,
                  row: str = "row", epoch: str = "epoch", batch: str = "batch", slot: str = "slot") -> DataFrame:
    """Every row once an epoch, each epoch in an order of its own, dealt into batches of exact size.

    Batches hold ``batch_size`` rows, the last one the rest; ``slot`` is a row's place in its batch.
    """
    places = F.array(*[F.struct(F.lit(e).alias("e"), Permutation(n, f"{seed}:{e}").column(row).alias("p")) for e in epochs])
    dealt = df.withColumn("_pg_e", F.explode(places))
    return (dealt.withColumn(epoch, F.col("_pg_e.e"))
            .withColumn(batch, F.floor(F.col("_pg_e.p") / F.lit(batch_size)).cast("long"))
            .withColumn(slot, (F.col("_pg_e.p") % F.lit(batch_size)).cast("int")).drop("_pg_e"))
