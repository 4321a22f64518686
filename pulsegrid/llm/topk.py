"""Exact top-k inner products by MaxScore over signed dimensions.

A dimension of the query is a term.  Its posting list is the vectors whose
component has the query component's sign: only they can gain from it, by at
most |q| times the largest component of that sign, and any other vector gains
at most 0.  Terms are ordered by that bound; the longest tail of terms whose
bounds sum to less than the current k-th score is non-essential, because a
vector in none of the other (essential) postings cannot reach the score.
Essential postings are traversed, then the terms are probed from the largest bound
down, and a vector is dropped once its partial sum plus the remaining bounds cannot
reach the k-th score.  Ties are kept while they can still win on the smaller id.

Queries are dealt into blocks and vectors into groups by a hash of their written
row number; both have a fixed number of components, so their size does not grow with
the data.  Each block meets each group in one task, which indexes the group in
shards and keeps its k best per query; a window with a partial limit merges the
groups.  Nothing passes through the driver but two counts.

Scores are exact at any size: components are kept as doubles in units of 1/1024,
which hold floor(1024 x) of every finite x, and where a bound of the products (taken
from the block and the group themselves) might not fit a long, the same search runs in
Python's integers.  Groups are merged by the scores' big-endian digits.

Edge cases: a vector that is NULL, or holds a NULL or non-finite component,
takes no part, nor does a row without id; missing components of a shorter
vector are 0, whatever the widest one has; each query row has its own results, also if
rows share an id; a query's own row is no candidate, other rows of its id are; equal
scores of one id are as many hits; a score beyond a long has its rank and a NULL in
the long column; an empty table gives no rows; other columns, and their names, are
not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import finite_on_grid, grid_integers, written

SCALE = 1024
#: Components of a block of queries, and of a group of vectors, that one task holds.
BLOCK_VALUES, GROUP_VALUES = 1 << 19, 1 << 19
#: Vectors in one shard's postings.
SHARD = 4096


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, vec_id, v) of the rows that take part, as a written table; v is in units of 1/SCALE."""
    whole = rows.select(F.col(key).cast("long").alias("vec_id"), finite_on_grid(vector, SCALE).alias("v"))
    return written(whole.where("vec_id is not null and v is not null").withColumn("row", F.monotonically_increasing_id()), "topk-vectors")


def _best_first(scores: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """The order of descending scores, then of ascending ties."""
    if scores.dtype != object:
        return np.lexsort((*ties[::-1], -scores))
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], *(t[i] for t in ties))), np.int64)


class Best:
    """The k best (score, id, row) of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.rows = k, *(np.zeros(0, np.int64) for _ in range(3))

    def least(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        every = [np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.rows, rows))]
        order = _best_first(*every)[: self.k]
        self.scores, self.ids, self.rows = (x[order] for x in every)


class Shard:
    """Postings of a run of vectors: per dimension, who is above and who is below 0, and the largest on each side."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.columns = rows, ids, np.ascontiguousarray(vectors.T)
        self.top, self.low = (vectors.max(axis=0, initial=0), vectors.min(axis=0, initial=0))
        self.above, self.below = ([np.flatnonzero(c.astype(bool)) for c in side] for side in (self.columns > 0, self.columns < 0))

    def search(self, row: int, q: np.ndarray, best: Best) -> None:
        bounds = np.where(q > 0, q * self.top, q * self.low)
        order = _best_first(bounds)
        order = order[(q[order] != 0).astype(bool)]
        # rest[i]: the most that terms i, i + 1, ... can add.
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        least = best.least()
        alive = self.rows != row
        if least is not None and least > 0:  # else a vector in no posting, which scores 0 or less, may still win
            essential = int((rest[:-1] >= least).sum())
            member = np.zeros(len(self.rows), bool)
            for d in order[:essential]:
                member[self.above[d] if q[d] > 0 else self.below[d]] = True
            alive = alive & member
        alive = np.flatnonzero(alive)
        partial = np.zeros(len(alive), q.dtype)
        for i, d in enumerate(order):
            if not len(alive):
                return
            partial = partial + q[d] * self.columns[d][alive]
            if least is not None and i % 8 == 7:
                keep = (partial + rest[i + 1] >= least).astype(bool)
                if not keep.all():
                    alive, partial = alive[keep], partial[keep]
        if least is not None:
            keep = (partial >= least).astype(bool)
            alive, partial = alive[keep], partial[keep]
        if len(partial) > best.k and partial.dtype != object:
            cut = np.partition(partial, len(partial) - best.k)[len(partial) - best.k]
            alive, partial = alive[partial >= cut], partial[partial >= cut]
        best.add(partial, self.ids[alive], self.rows[alive])


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of doubles as rows, filled up with zeros."""
    flat = lists.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def digits(score: int) -> tuple[int, bytes]:
    """(size, bytes) that are ordered like the integers they stand for."""
    size = max(1, (abs(score).bit_length() + 7) // 8)
    raw = abs(score).to_bytes(size, "big")
    return (size, raw) if score >= 0 else (-size, bytes(255 - b for b in raw))


FOUND = "query bigint, query_id bigint, row bigint, vec_id bigint, score bigint, size int, digits binary"


def _search(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and vectors.num_rows:
            width = max(queries.column("block_n").to_numpy().max(), vectors.column("group_n").to_numpy().max(), 1)
            q, v = (grid_integers(matrix(x, width), SCALE) for x in (queries.column("block_v"), vectors.column("group_v")))
            # Python's integers, if some partial sum might leave a long.
            reach = sum(int(a) * int(b) for a, b in zip(np.abs(q).max(axis=0), np.abs(v).max(axis=0), strict=True))
            kind = np.int64 if reach < 1 << 62 and q.dtype != object and v.dtype != object else object
            q, v = q.astype(kind), v.astype(kind)
            rows, ids = vectors.column("group_row").to_numpy(), vectors.column("group_vec_id").to_numpy()
            own, own_ids = queries.column("block_row").to_numpy(), queries.column("block_vec_id").to_numpy()
            best = [Best(k) for _ in own]
            for lo in range(0, len(rows), SHARD):
                shard = Shard(rows[lo: lo + SHARD], ids[lo: lo + SHARD], v[lo: lo + SHARD])
                for row, vector, b in zip(own.tolist(), q, best, strict=True):
                    shard.search(row, vector, b)
            for row, query_id, b in zip(own.tolist(), own_ids.tolist(), best, strict=True):
                for score, vec_id, hit in zip(b.scores.tolist(), b.ids.tolist(), b.rows.tolist(), strict=True):
                    out.append((row, query_id, hit, vec_id, score if -(1 << 63) <= score < 1 << 63 else None, *digits(score)))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "query_id", "row", "vec_id", "score", "size", "digits"])

    return run


def top_k(rows: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k highest scores, ties to the smaller id."""
    vectors = integer_vectors(rows, key, vector).withColumn("n", F.size("v"))
    queries = vectors.where(is_query(F.col("vec_id")))
    (n_vectors, widest), n_queries = vectors.agg(F.count(F.lit(1)), F.max("n")).first(), queries.count()
    blocks = -(-n_queries // max(1, BLOCK_VALUES // max(1, widest or 0)))
    groups = -(-n_vectors // max(1, GROUP_VALUES // max(1, widest or 0)))

    def dealt(df: DataFrame, own: str, n: int, other: str, others: int):
        """Each row to its own block (or group) of ``n``, once for each of the others that it meets."""
        at = F.pmod(F.xxhash64("row"), F.lit(max(1, n))).cast("int").alias(own)
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)) if others else F.array().cast("array<int>")).alias(other)
        # Both sides come from one table: under names of their own, so that neither takes the other's columns.
        return df.select(*[F.col(c).alias(f"{own}_{c}") for c in ("row", "vec_id", "v", "n")], at, each).groupBy("block", "group")

    met = dealt(queries, "block", blocks, "group", groups).cogroup(dealt(vectors, "group", groups, "block", blocks))
    found = met.applyInArrow(_search(k), FOUND)
    order = Window.partitionBy("query").orderBy(F.col("size").desc(), F.col("digits").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
