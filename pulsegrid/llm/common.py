"""Shared helpers: scratch tables, Arrow text access, blockwise word hashing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_path

#: Bytes of text that one vectorised pass handles (its arrays take about 40 bytes each).
BLOCK_BYTES = 1 << 20
#: Rows of a key up to which a shuffle join may bring them to one task.
HOT_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below the shared checkpoint folder: its lineage is cut there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``most`` rows (it is counted); else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def met(rows: DataFrame, side: DataFrame, keys: list[str], most: int, hot: int = HOT_ROWS, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner or left) with ``side``, which has one row per key and in ``held`` the number of ``rows`` with it.

    A side of at most ``most`` rows is broadcast.  Of a larger one the rows of hot keys are: as many
    rows hold each of them, there are at most ``most``.  The other keys, each of at most
    ``hot`` rows or a ``most``-th of all, meet in a shuffle join.
    """
    n, total = side.agg(F.count(F.lit(1)), F.sum("held")).first()
    if n <= most:
        return rows.join(F.broadcast(side), keys, how)
    often = F.col("held") > max(hot, total // most)
    hottest = side.where(often)
    cold = rows.join(F.broadcast(hottest.select(*keys)), keys, "left_anti").join(side.where(~often), keys, how)
    return rows.join(F.broadcast(hottest), keys).unionByName(cold)


def crc32_text(col) -> object:
    """Unsigned CRC-32 of a value's text; a NULL counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def on_grid(x: Column, scale: int) -> Column:
    """floor(scale * x) / scale of a finite double, exactly, for a power of two as scale."""
    # From 2^53 / scale on a double's spacing is 1/scale or more, so it is on the grid itself.
    return F.when(F.abs(x) >= float(2**53 // scale), x).otherwise(F.floor(x * scale) / scale)


def finite_on_grid(vector: str | Column, scale: int) -> Column:
    """The vector's components on the grid as doubles; NULL if it is NULL or holds a NULL or non-finite one."""
    x = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda c: c.cast("double"))
    clean = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    return F.when(clean, F.transform(x, lambda c: on_grid(c, scale)))


def grid_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """Grid values times ``scale``: int64 if all fit, else Python's integers."""
    if not x.size or np.abs(x).max() < 2.0**61 / scale:
        return (x * scale).astype(np.int64)
    whole = float(2**53 // scale)
    return np.array([int(v * scale) if abs(v) < whole else int(v) * scale for v in x.ravel().tolist()], object).reshape(x.shape)


def largest(x: np.ndarray) -> int:
    """The largest magnitude in an array of integers; 0 of none."""
    return int(max(x.max(initial=0), -x.min(initial=0))) if x.size else 0


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string or binary Arrow column as bytes; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def slices(texts: Sequence[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes (a longer text stands alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text whose separators are spaces, in blocks of about ``BLOCK_BYTES``."""
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK_BYTES)
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            cut = text.find(b" ", end) if cut < 0 else cut
            end = len(text) if cut < 0 else cut + 1
        yield text[at:end].split()
        at = end


def lower_table(separators: bytes) -> bytes:
    """Byte map: A-Z to a-z, each separator to a space, all else unchanged."""
    table = bytearray(range(256))
    table[65:91] = bytes(range(97, 123))
    for b in separators:
        table[b] = 32
    return bytes(table)


#: Words are runs of anything but space and \x09-\x0D.
SPACE_WORDS = lower_table(bytes([32, *range(9, 14)]))
#: Words are runs of digits, letters a-z (after lower-casing) and non-ASCII characters.
ALNUM_WORDS = lower_table(bytes(b for b in range(128) if not chr(b).isalnum()))

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BYTES[32] = 0
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = (np.full(size, m, np.uint64) for m in (_MULTIPLIER, _INVERSE))
        for x in (up, down):
            x[0] = 1
            np.multiply.accumulate(x, out=x)
        _POWERS[size] = up, down
    return _POWERS[size]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes, shifted to its own start."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    sums = np.add.reduceat(_BYTES[data] * up[: len(data)], starts) * down[starts]
    return mix64(sums + (ends - starts).astype(np.uint64))


def hash_words(texts: Sequence[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, in order, and the number of words of each text.

    Works in blocks cut at separators, so a very long text needs 8 bytes a word
    besides one block's arrays.
    """
    joined = b" ".join(texts).translate(table)
    hashes, at, pos = [], [], 0
    while pos < len(joined):
        end = min(len(joined), pos + BLOCK_BYTES)
        if end < len(joined):
            cut = joined.rfind(b" ", pos, end)
            if cut < 0:
                cut = joined.find(b" ", end)
            end = len(joined) if cut < 0 else cut + 1
        data = np.frombuffer(joined, np.uint8, end - pos, pos)
        starts, ends = word_spans(data)
        hashes.append(span_hashes(data, starts, ends))
        at.append(starts + pos)
        pos = end
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts = np.concatenate(at) if at else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, first))
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts
