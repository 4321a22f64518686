"""Product codes of vectors: codebooks refined over a trie of the distinct parts.

Each vector becomes integers floor(4096 x) and is cut into ``PARTS`` parts.  The
distinct parts of each position are counted once and written in lexicographic
order, which is the order in which a depth-first traversal of their trie comes to
its leaves.  A node's vector holds the squared differences of its path to all
codebook entries, summed so far; a child adds its own component, so parts with a
common prefix share the prefix's work.  Leaves are taken in runs: the nodes that a
run opens are computed level by level from their parents, and the path that is
open at its end stays on a stack for the next run.  A leaf takes the smallest
distance (ties to the lower entry) and adds its count and its components, times the
count, to its entry's sums.  Results do not depend on how the leaves are
ordered or dealt, only the sharing does.

A round moves the codebooks (parts x entries x components integers, of a size that
the vector's width sets) to the tasks and sums of that size back.  Codes and errors of
all vectors are a last pass over the vectors, each batch a trie of its own.

Integers are exact at any size: components are kept in units of 1/4096 as doubles,
which hold floor(4096 x) of every finite x, a run whose distances might not fit a long
is computed in Python's integers, and sums travel in 32-bit limbs.

Edge cases: a vector that is NULL, or holds a NULL or non-finite component, is
dropped; a vector shorter than the widest, and one whose width is no multiple of
the parts, is filled up with zeros; a codebook starts with as many entries as
there are ids, if fewer than 16; rows of one id start it once, with the least of
their vectors; a NULL id counts as the largest; repeated rows are coded each; an
error beyond a long is NULL, and so is the label's error that holds it or is itself
beyond; an empty table (or one that keeps no vector) gives no rows; other columns, and
their names, are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bounded, finite_on_grid, grid_integers, largest, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Leaves whose nodes are held at once.
RUN = 8192
#: Labels with their sums that a broadcast may have; beyond, a shuffle join.
BROADCAST_ROWS = 1_000_000
_LONG = 1 << 62

Books = list[list[list[int]]]


def kept_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the rows that stay, as a written table, and the width of a part."""
    kept = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), finite_on_grid(vector, SCALE).alias("v")).where("v is not null")
    kept = written(kept, "codes-vectors")
    widest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-widest // PARTS)
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width * PARTS) - F.size("v")))
    return kept.select("vec_id", "label", filled.alias("v")), width


def distinct_parts(kept: DataFrame, width: int) -> DataFrame:
    """(position, part, n), written in order."""
    cut = F.array(*[F.slice("v", p * width + 1, width) if width else F.array().cast("array<double>") for p in range(PARTS)])
    parts = kept.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count(F.lit(1)).alias("n"))
    return written(parts.orderBy("position", "part"), "codes-parts")


class Traversal:
    """Depth-first over the parts of one position, in runs of sorted leaves."""

    def __init__(self, book: list[list[int]]):
        self.book = np.array(book, object).reshape(len(book), len(book[0]) if book else 0)
        self.reach = largest(self.book)
        self.last: np.ndarray | None = None
        self.stack: list[np.ndarray] = []

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of each row of ``x`` to all entries."""
        n, width = x.shape
        if not width:
            return np.zeros((n, len(self.book)), np.int64)
        # A long holds the sums of all parts of a vector.
        small = x.dtype != object and PARTS * width * (largest(x) + self.reach) ** 2 < _LONG
        kind = np.int64 if small else object
        x, book = x.astype(kind), self.book.astype(kind)
        if self.last is None or self.last.dtype != x.dtype:
            self.last, self.stack, known = x[0], [np.zeros(len(book), kind)] * width, 0
        else:
            known = int(np.logical_and.accumulate(np.equal(x[0], self.last).astype(bool)).sum())
        same = np.equal(x[1:], x[:-1]).astype(bool)
        shared = np.append(known, np.logical_and.accumulate(same, axis=1).sum(axis=1)).astype(np.int64)
        # Node 0 of each level is the open path's.
        above, node = np.zeros((1, len(book)), kind), np.zeros(n, np.int64)
        for depth in range(width):
            new = np.flatnonzero(shared <= depth)
            gap = x[new, depth][:, None] - book[:, depth]
            sums = np.concatenate([self.stack[depth][None], above[node[new]] + gap * gap])
            opened = np.zeros(n, np.int64)
            opened[new] = 1
            node = np.cumsum(opened)
            above = sums
            self.stack[depth] = sums[node[-1]]
        self.last = x[-1]
        return above[node]


def _runs(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, components, counts) of consecutive rows of one position."""
    positions, counts = batch.column("position").to_numpy(), batch.column("n").to_numpy()
    values = batch.column("part").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(positions)) + 1, [len(positions)]])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        for at in range(lo, hi, RUN):
            to = min(hi, at + RUN)
            yield int(positions[lo]), grid_integers(values[at:to], SCALE), counts[at:to]


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    sign, x, i = (-1, -x, 0) if x < 0 else (1, x, 0)
    while x:
        if low := x & 0xFFFFFFFF:
            yield i, sign * low
        x, i = x >> 32, i + 1


SUMS = "position int, entry int, component int, limb int, value bigint"


def _summed(books: Books, width: int):
    """Sums of one task: component -1 is the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [Traversal(book) for book in books]
        sums: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for position, x, n in _runs(batch, width) if batch.num_rows else ():
                entry = walks[position].distances(x).argmin(axis=1)
                kind = np.int64 if x.dtype != object and largest(x) * int(n.sum()) < _LONG else object
                chosen = (entry == np.arange(len(books[position]))[:, None]).astype(kind)
                weighted = chosen @ (x.astype(kind) * n.astype(kind)[:, None])
                for e, (count, row) in enumerate(zip((chosen @ n.astype(kind)).tolist(), weighted.tolist(), strict=True)):
                    if count:
                        for c, v in enumerate([count, *row], -1):
                            sums[position, e, c] = sums.get((position, e, c), 0) + v
        rows = [(*key, limb, low) for key, v in sums.items() for limb, low in _limbs(v)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()], strict=True)], ["position", "entry", "component", "limb", "value"])

    return run


def first_books(kept: DataFrame, width: int) -> Books:
    ids = kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES)
    first = kept.join(F.broadcast(ids.withColumnRenamed("vec_id", "first_id")), F.col("vec_id").eqNullSafe(F.col("first_id")))
    rows = first.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    vectors = [grid_integers(np.array(r["v"], float), SCALE).tolist() for r in rows]
    return [[v[p * width: (p + 1) * width] for v in vectors] for p in range(PARTS)]


def next_books(books: Books, parts: DataFrame, width: int) -> Books:
    """One round: every entry that has parts becomes the floor of their mean."""
    sums = parts.mapInArrow(_summed(books, width), SUMS).groupBy("position", "entry", "component", "limb").agg(F.sum("value").alias("value"))
    total: dict[tuple[int, int], dict[int, int]] = {}
    for position, entry, component, limb, value in sums.collect():  # as many as the codebooks have numbers
        held = total.setdefault((position, entry), {})
        held[component] = held.get(component, 0) + (value << 32 * limb)
    return [[[total[p, e].get(c, 0) // total[p, e][-1] for c in range(width)] if (p, e) in total else old
             for e, old in enumerate(book)] for p, book in enumerate(books)]


def _coded(books: Books, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, RUN):
                batch = whole.slice(lo, RUN)
                n = batch.num_rows
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS, width)
                codes, errors = np.zeros((n, PARTS), np.uint8), [0] * n
                for p, book in enumerate(books):
                    x = values[:, p]
                    order = np.lexsort(x.T[::-1]) if width else np.arange(n)
                    far = Traversal(book).distances(grid_integers(x[order], SCALE))
                    entry = far.argmin(axis=1)
                    codes[order, p] = entry
                    for i, d in zip(order.tolist(), far[np.arange(n), entry].tolist(), strict=True):
                        errors[i] += d
                fits = [e if e < 1 << 63 else None for e in errors]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(fits, pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return run


def books_digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the sum of ``error`` over equal labels (NULLs together); pre-aggregated, so a hot label is a row per task."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count_if(F.col("error").isNull()) == 0) & (total < F.lit(str(1 << 63)).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.when(fits, total).cast("long").alias("label_error"))
    sums = bounded(written(sums, "codes-labels"), BROADCAST_ROWS)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error, label_error) of the kept rows, and the final codebooks."""
    kept, width = kept_vectors(rows, key, vector, label)
    books = first_books(kept, width)
    parts = distinct_parts(kept, width)
    for _ in range(ROUNDS):
        books = next_books(books, parts, width)
    schema = f"vec_id bigint, label {kept.schema['label'].dataType.simpleString()}, code string, error bigint"
    coded = written(kept.mapInArrow(_coded(books, width), schema), "codes-coded")
    return with_label_errors(coded), books


def report(rows: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)."""
    coded, books = compress(rows)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
