"""Sequence packing by non-negative least squares over length combinations.

1. One Arrow pass tokenises whole texts (a cache of words makes that a lookup)
   and cuts each document into full windows and one remainder.
2. The histogram of remainder lengths (at most ``window`` numbers) goes to the
   driver.  Combinations of up to three lengths that fill a window exactly are
   the columns of a non-negative least-squares problem against the histogram;
   coordinate descent solves it, and counts are rounded down.
3. What rounding left is packed greedily: the longest remaining length, then
   the longest that still fits, repeated as often as the counts allow.
4. Each remainder's rank among those of its length picks its window and offset
   from the plan.  Ranks come from a range sort of narrow rows, so one frequent
   length is split over tasks.

The plan's size depends on the window alone, never on the number of documents.

Edge cases: a NULL or empty text is its end id alone; repeated rows are packed
like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import BLOCK_BYTES, SPACE_WORDS, as_bytes, slices, span_hashes, word_spans, written

WINDOW, END = 2048, 1
#: Words that a worker remembers; beyond, it starts anew.
CACHE_WORDS = 1_000_000

#: Per byte: 1 for an ASCII letter or digit (lower case), 2 for a mark that may close a word, 3 for a space.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 1
_KIND[list(b".,!?;:*$%&#|()")] = 2
_KIND[32] = 3
#: Stands between words that are encoded together: a token of its own, next to no other.
_BETWEEN = "\x01"


class WordCache:
    """Token ids of texts, by their words.

    The tokenizer lower-cases and drops white space, and no rule of it reaches
    across white space, so a text's ids are its words' ids in order.  Nor does
    one reach from a letter or digit to the marks that close a word, so those
    are words of their own.  Words are known by a 64-bit hash; ids lie in one
    array.  A worker keeps one cache for all its tasks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self.encode(_BETWEEN)
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """Add words that are not known; ``keys`` ascend."""
        ids: list[np.ndarray] = []
        sizes = np.zeros(len(words), np.int64)
        for i in range(0, len(words), 2000):
            part = words[i: i + 2000]
            if any(b"\x01" in w for w in part):
                own = [self.encode(w.decode()) for w in part]
                ids += own
                sizes[i: i + len(part)] = [len(x) for x in own]
            else:
                all_ids = self.encode(f" {_BETWEEN} ".join([w.decode() for w in part]))
                mark = all_ids == self.between
                ids.append(all_ids[~mark])
                ends = np.append(np.flatnonzero(mark), len(all_ids))
                sizes[i: i + len(part)] = np.diff(np.concatenate([[-1], ends])) - 1
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used: self.used + len(flat)] = flat
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.start, starts), (self.size, sizes)))

    def _some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of texts without a special token's opening."""
        low = np.frombuffer(b" ".join([*texts, b""]).translate(SPACE_WORDS), np.uint8)
        kind = _KIND[low]
        mark = np.concatenate([[False], kind == 2, [False]])
        edge = np.flatnonzero(mark[1:] != mark[:-1])
        first, after = edge[::2], edge[1::2]
        apart = first[(kind[first - 1] == 1) & (kind[after] == 3) & (first > 0)]
        data = np.insert(low, apart, 32)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bounds = bounds + np.searchsorted(apart, bounds)
        starts, ends = word_spans(data)
        keys, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        new = ~np.isin(keys, self.keys, assume_unique=True)
        if new.any():
            raw = data.tobytes()
            self.learn(keys[new], [raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
        at = np.searchsorted(self.keys, keys)[which]
        sizes = self.size[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.start[at] - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(starts, bounds)])

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        # A special token's text must keep its case and place, and may hold marks.
        plain = [b"" if b"<|" in t else t for t in texts]
        ids, counts = self._some(plain)
        cuts = np.cumsum([0, *counts]).tolist()
        return [self.encode(t.decode()) if b"<|" in t else ids[a:b] for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True)]

    def long(self, text: bytes) -> np.ndarray:
        """The ids of a text of any length, segment by segment, cut at white space."""
        if b"<|" in text or len(text) <= 2 * BLOCK_BYTES:
            return self.ids([text])[0]
        out, pos = [], 0
        while pos < len(text):
            end = text.find(b" ", pos + BLOCK_BYTES)
            end = len(text) if end < 0 else end
            out.append(self.ids([text[pos:end]])[0])
            pos = end
        return np.concatenate(out)


_CACHES: dict[str, WordCache] = {}


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _cut(path: str, window: int, end: int, keep_ids: bool):
    tail = np.array([end], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _CACHES:
            _CACHES[path] = WordCache(path)
        cache = _CACHES[path]
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                rows = []
                made = cache.ids(texts[lo:hi]) if hi - lo > 1 else [cache.long(texts[lo])]
                for doc, ids in zip(docs[lo:hi], made, strict=True):
                    raw = np.concatenate([ids, tail]).astype("<u4").tobytes()
                    n = len(raw) // 4
                    for s in range(0, n, window):
                        piece = raw[4 * s: 4 * (s + window)]
                        rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n, piece))
                cols = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    cols.append(pa.array([np.frombuffer(r[5], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def combinations(window: int) -> np.ndarray:
    """All ways to fill a window with one, two or three lengths, ascending (0: unused)."""
    a = np.arange(window // 3 + 1)[:, None]
    b = np.arange(window // 2 + 1)[None, :]
    c = window - a - b
    # a = 0 gives the pairs, and b = 0 with it the whole window; these come first.
    x, y = np.nonzero((a <= b) & (b <= c))
    return np.stack([x, y, window - x - y], axis=1)


def solve(columns: list[tuple[int, ...]], histogram: list[int], sweeps: int = 4) -> list[float]:
    """x >= 0 that brings sum over columns of x near the histogram in least squares.

    Cyclic coordinate descent: each step sets one count to its exact minimiser
    given the others, not below 0.  Starting from zero it favours few columns
    with large counts, which lose little in rounding.
    """
    left, x = [float(v) for v in histogram], [0.0] * len(columns)
    for _ in range(sweeps):
        for j, lengths in enumerate(columns):
            pull = 0.0
            for v in lengths:
                pull += left[v]
            if pull > 0 or x[j] > 0:
                norm = len(lengths) if len(set(lengths)) == len(lengths) else sum(lengths.count(v) for v in lengths)
                new = x[j] + pull / norm
                if new < 0:
                    new = 0.0
                move, x[j] = new - x[j], new
                for v in lengths:
                    left[v] -= move
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """[(lengths of a window, repeats)] that uses every piece of the histogram exactly once."""
    left = histogram.astype(np.int64).copy()
    columns = combinations(window)
    used = [tuple(v for v in c if v) for c in columns[((histogram[columns] > 0) | (columns == 0)).all(axis=1)].tolist()]
    out: list[tuple[list[int], int]] = []
    x = solve(used, histogram.tolist())
    # Rounded down, the largest first, and never beyond what a length still has.
    for i in sorted((i for i, v in enumerate(x) if v >= 1), key=lambda i: (-x[i], i)):
        lengths = list(used[i])
        need = {v: lengths.count(v) for v in lengths}
        times = min(int(x[i]), min(int(left[v]) // k for v, k in need.items()))
        if times > 0:
            for v, k in need.items():
                left[v] -= times * k
            out.append((lengths, times))
    while left.any():
        room, lengths, have = window, [], left.copy()
        while room:
            fit = np.flatnonzero(have[1: room + 1])
            if not len(fit):
                break
            v = int(fit[-1]) + 1
            take = min(int(have[v]), room // v)
            lengths += [v] * take
            have[v] -= take
            room -= v * take
        need = {v: lengths.count(v) for v in set(lengths)}
        times = min(int(left[v]) // k for v, k in need.items())
        for v, k in need.items():
            left[v] -= times * k
        out.append((lengths, times))
    return out


class Slots:
    """The plan as intervals: for each length, ranks [from, ...) lie in windows base, base + 1, ... at one offset."""

    def __init__(self, steps: list[tuple[list[int], int]]):
        rows, base, used = [], 0, {}
        for lengths, times in steps:
            offset = 0
            for v in lengths:
                rows.append((v, used.get(v, 0), base, offset))
                used[v] = used.get(v, 0) + times
                offset += v
            base += times
        order = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.rows, self.key = order, order[:, 0] * (1 << 44) + order[:, 1]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * (1 << 44) + rank, side="right") - 1
        _, first, base, offset = self.rows[at].T
        return base + rank - first, offset


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if kept).

    Sequences are the pieces with one ``sequence_id`` in order of ``offset``; the
    rest of the window is padding.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    pieces = written(source.mapInArrow(_cut(tokenizer, window, end, keep_ids), schema).withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    order = ["length", "doc_id", "start", "ids_crc32", "_row"]
    narrow = pieces.drop("ids")
    placed = written(narrow.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "pack-order")
    # A sorted partition holds a contiguous range of lengths: at most (partitions + window) runs.
    runs = placed.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    runs = written(runs, "pack-runs")
    histogram = np.zeros(window + 1, np.int64)
    for r in runs.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(Slots(plan(histogram, window)))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_part", "length", "_first", F.coalesce(before, F.lit(0)).cast("long").alias("_before"))
    ranked = placed.join(F.broadcast(runs), ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_at") - F.col("_first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                seq, offset = slots.value.place(*(b.column(c).to_numpy() for c in ("length", "_rank")))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in [*names, "_row"]), pa.array(seq), pa.array(offset)], [*names, "_row", "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    out = ranked.select(*names, "_row", "_rank").mapInArrow(run, PIECES + ", _row bigint, sequence_id bigint, offset bigint")
    if keep_ids:
        out = out.join(pieces.select("_row", "ids"), "_row")
    return out.drop("_row")
