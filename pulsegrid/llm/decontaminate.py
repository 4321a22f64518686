"""Benchmark decontamination by windows of normalised words.

The benchmark's windows are hashed (one 64-bit hash per window of 10 words, or
of all words of a shorter item) and broadcast in blocks of a fixed number of
windows; documents stream past in Arrow batches.  A hit of a hash is verified
on the words' own bytes.  Each word inside a verified occurrence is hit, and
spans or whole documents can be removed.

A benchmark of any size works: each block of ``BLOCK_WINDOWS`` windows is one
scan over the documents, and the hits of all blocks are merged per document.

Edge cases: NULL or word-less texts have no words and no hits; an item without
words has no window; items with the same words all count, a repeated item id
counts once and a NULL id not at all; an empty benchmark hits nothing; an empty
table gives no rows; other columns are kept as they are, but for those named
like a result column, which the result replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import ALNUM_WORDS, as_bytes, hash_words, slices, written

WINDOW = 10
#: Windows in one broadcast block (about 100 bytes each on a worker).
BLOCK_WINDOWS = 1_000_000

_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for i in range(size):
            out = out * _STEP + words[i: n + i]
    return out


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


class Windows:
    """A block of benchmark windows: sorted hashes by length, and for each hash its words and items."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.by_size: dict[int, dict[int, dict[bytes, set[int]]]] = {}
        for item, joined in rows:
            words = joined.split(b" ")
            key = int(window_hashes(hash_words([joined], ALNUM_WORDS)[0], len(words))[0])
            self.by_size.setdefault(len(words), {}).setdefault(key, {}).setdefault(joined, set()).add(item)
        self.sorted = {n: np.sort(np.fromiter(d, np.uint64, len(d))) for n, d in self.by_size.items()}

    def candidates(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, size, hash) of all window hashes found among a run of word hashes."""
        found = []
        for size, keys in self.sorted.items():
            hashes = window_hashes(words, size)
            if len(hashes):
                at = np.searchsorted(keys, hashes)
                at[at == len(keys)] = 0
                found += [(int(i), size, int(hashes[i])) for i in np.flatnonzero(keys[at] == hashes)]
        return found


def _scan(windows, columns: list[str]):
    """For each document: its number of words, hit word ranges [start, end) merged, and hit items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Windows = windows.value
        for batch in batches:
            texts = as_bytes(batch.column("_text"))
            totals, ranges, items = [], [], []
            for lo, hi in slices(texts):
                hashes, counts = hash_words(texts[lo:hi], ALNUM_WORDS)
                ends = np.cumsum(counts)
                per_doc: dict[int, list[tuple[int, int, int]]] = {}
                for start, size, key in block.candidates(hashes):
                    doc = int(np.searchsorted(ends, start, side="right"))
                    if start + size <= ends[doc]:
                        per_doc.setdefault(doc, []).append((start - int(ends[doc] - counts[doc]), size, key))
                for doc, total in enumerate(counts):
                    spans: list[list[int]] = []
                    hit: set[int] = set()
                    if doc in per_doc:
                        words = words_of(texts[lo + doc])
                        for start, size, key in sorted(per_doc[doc]):
                            owners = block.by_size[size][key].get(b" ".join(words[start: start + size]))
                            if owners:
                                hit |= owners
                                if spans and start <= spans[-1][1]:
                                    spans[-1][1] = max(spans[-1][1], start + size)
                                else:
                                    spans.append([start, start + size])
                    totals.append(int(total)), ranges.append([{"start": a, "end": b} for a, b in spans]), items.append(sorted(hit))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(totals, pa.int64()), pa.array(ranges, span), pa.array(items, pa.list_(pa.int64()))],
                columns + ["n_words", "hit_ranges", "hit_items"])

    return run


def benchmark_windows(benchmark: DataFrame, size: int, item: str, text: str) -> DataFrame:
    """(item, window): the distinct windows of every item, words joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text")), strict=True):
                words = words_of(t)
                n = min(size, len(words))
                found = {b" ".join(words[k: k + n]) for k in range(len(words) - n + 1)} if words else set()
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array(sorted(found), pa.binary())], ["item", "joined"])

    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).where("item is not null")
    return rows.mapInArrow(cut, "item bigint, joined binary").distinct()


def window_blocks(windows: DataFrame) -> Iterator[Windows]:
    """The windows in blocks that the driver can hold, one after another."""
    rows: list[tuple[int, bytes]] = []
    for r in windows.toLocalIterator():
        rows.append((r["item"], bytes(r["joined"])))
        if len(rows) == BLOCK_WINDOWS:
            yield Windows(rows)
            rows = []
    if rows:
        yield Windows(rows)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, hit_ranges (word positions, end exclusive, merged) and hit_items.

    One block (the usual case) is a map-only pass.  With more, the documents get
    a row id, each block's hits are written, and those of a row are merged.
    """
    spark = docs.sparkSession
    docs = docs.drop("_text", "n_words", "hit_ranges", "hit_items")
    blocks = window_blocks(benchmark_windows(benchmark, size, item, item_text))
    first, second = next(blocks, None) or Windows([]), next(blocks, None)

    def one(frame: DataFrame, block: Windows) -> DataFrame:
        keep = frame.columns
        extra = "n_words bigint, hit_ranges array<struct<start:bigint,end:bigint>>, hit_items array<bigint>"
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema) + ", " + extra
        return frame.withColumn("_text", F.col(text)).mapInArrow(_scan(spark.sparkContext.broadcast(block), keep), schema)

    if second is None:
        return one(docs, first)
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "decon-rows")
    narrow = rows.select("_row", F.col(text))
    parts = [written(one(narrow, b).drop(text), "decon-hits") for b in (first, second, *blocks)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.union(p)
    merged = merged.groupBy("_row").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hit_ranges"))).alias("hit_ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"))
    joined = F.aggregate(
        "hit_ranges", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, r: F.when((F.size(out) > 0) & (r.start <= F.element_at(out, -1).end), F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(F.element_at(out, -1).start.alias("start"), F.greatest(F.element_at(out, -1).end, r.end).alias("end")))))
        .otherwise(F.concat(out, F.array(r))))
    return rows.join(merged.withColumn("hit_ranges", joined), "_row").drop("_row")


def without_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Scanned documents with every hit word range cut out of the text (from its first word to before the next kept word)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, ranges in zip(batch.column(text).to_pylist(), batch.column("hit_ranges").to_pylist(), strict=True):
                if ranges:
                    raw = t.encode()
                    inside = np.concatenate([[False], np.frombuffer(raw.translate(ALNUM_WORDS), np.uint8) != 32, [False]])
                    starts = np.append(np.flatnonzero(inside[1:] & ~inside[:-1]), len(raw))
                    kept, pos = [], 0
                    for r in ranges:
                        kept.append(raw[pos: starts[r["start"]]])
                        pos = starts[r["end"]]
                    t = (b"".join(kept) + raw[pos:]).decode()
                out.append(t)
            i = batch.schema.get_field_index(text)
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return docs.mapInArrow(cut, docs.schema)


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    hits = scan(docs.select(key, "text"), benchmark)
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda a, r: a + r.end - r.start)
    ids = F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ",")
    return hits.select(key, "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                       F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
