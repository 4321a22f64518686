"""A hierarchical Pitman-Yor language model over whole texts, with Gibbs-sampled seatings.

Restaurants: a token's context is the token before it (the end token's starts a
text); ``RESTAURANTS`` context restaurants, found by a hash of that token, share one
unigram parent, whose own parent is the uniform distribution over the known tokens
and one unknown.  Their number is a constant, so what all tasks need (customers and
tables of each restaurant) has a fixed size; rare previous words may share one.

1. Tokens are counted as (word, restaurant) pairs, merged before and after a shuffle
   by ranges of the word's hash.  A word with very many restaurants is merged by
   ranges of restaurants first.  A type has at most ``RESTAURANTS`` pairs.
2. A pair seen once sits at one table for certain.  For the others each Gibbs sweep
   draws the number of tables from its conditional given all other tables: with n
   customers of one dish, t tables have the weight of S(n, t) (generalised Stirling
   numbers: the seatings of n customers at t tables) times the probabilities of t
   new tables, one after the other, in the restaurant and at the parent, without
   the pair's own tables.  This takes all customers of the pair out and seats them
   again at once.  A type's pairs are drawn in turn (past ``TURNS`` in as many groups);
   the other types are taken as the sweep before left them.  The parent's tables of a
   dish are drawn alike.  S is a table up to ``EXACT`` customers; past it the
   coefficients of its generating function, by a series for few tables and the saddle
   point for many, which are right to 4 % at worst (1 % for discounts of 0.3 and more).
   Every draw is a hash of word, restaurant and sweep, so neither the layout nor a
   repeated task changes it.
3. After ``BURN_IN`` sweeps ``KEPT`` sweeps are averaged: p(w | u) is the mean of their
   predictive probabilities, a distribution over the known tokens and the unknown.
4. Texts do not move: their tokens do, packed, to the range that has their word;
   there they get their probabilities, summed per text, and the sums go back to the
   texts' ids.  Tokens of a word with more than ``HOT_TOKENS`` go to several copies of its pairs.

Rows between tasks are packed arrays of many tokens or pairs (``pack``); Spark
shuffles, groups and writes them.

Edge cases: a NULL or blank text is the end token alone; an empty training set
leaves the uniform distribution over one unknown token; repeated rows count and are
scored each; a text is never cut, and a very long one needs about 40 bytes a token
in one task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import SPACE_WORDS, as_bytes, crc32_text, hash_words, mix64, slices, written
from pulsegrid.session import scratch_path

CONTEXT_BITS = 22
RESTAURANTS = 1 << CONTEXT_BITS
BURN_IN, KEPT = 2, 3
STRENGTH = 1.0
#: Customers of a dish up to which Stirling numbers are tabulated.
EXACT = 1024
#: Groups of a type's pairs that are drawn in turn.
TURNS = 16
#: Tokens packed together, and text bytes behind one range of words.
FLUSH_TOKENS, RANGE_BYTES = 4_000_000, 16 << 20
#: Pairs of one word that may meet in one merge before they are merged by restaurants.
MERGED = 1 << 24
#: Tokens of one word that are scored together.
HOT_TOKENS = 1 << 23
#: Ranges of restaurants whose sums are added up together.
SUM_RANGES = 64

_END = np.uint64(0x5851F42D4C957F00)  # no word: words' keys come from a hash
_MIX = np.uint64(0x9FB21C651E98DF25)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of one place stand together, as the high ones are mostly alike."""
    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpack(value: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T.copy().view(kind).reshape(n))
        at += n * width
    return out


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of all texts, the restaurant of each, and tokens per text."""
    words, counts = hash_words(texts, SPACE_WORDS)
    place = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)
    keys = np.full(len(words) + len(counts), _END, np.uint64)
    keys[place] = words
    # The token before a text's first is the end token of the text before.
    return keys, restaurants(np.append(_END, keys)[:-1]), counts + 1


def restaurants(previous: np.ndarray) -> np.ndarray:
    return (mix64(previous ^ _MIX) >> np.uint64(64 - CONTEXT_BITS)).astype(np.uint32)


def range_of(words: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each word's hash; it grows with the hash."""
    return ((words >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def merged(words: np.ndarray, which: np.ndarray, context: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, restaurant, count) of pairs in order, equal ones added up; ``which`` is each pair's place in ``words``, without ``n`` each counts 1."""
    words, place = np.unique(words, return_inverse=True)
    key = place[which] << CONTEXT_BITS | context
    if n is None:
        key = np.sort(key)
    elif (key[1:] <= key[:-1]).any():
        order = np.argsort(key)
        key, n = key[order], n[order]
    cuts = _runs(key)
    key = key[cuts[:-1]]
    n = np.diff(cuts) if n is None else np.add.reduceat(n, cuts[:-1]) if len(n) else n
    return words[key >> CONTEXT_BITS], (key & (RESTAURANTS - 1)).astype(np.uint32), n


PAIRS = ("<u8", "<u4", "<u4", "<i8")  # words, pairs of each, their restaurants and counts


def pack_pairs(word: np.ndarray, context: np.ndarray, n: np.ndarray) -> bytes:
    cuts = _runs(word)
    return pack(word[cuts[:-1]], np.diff(cuts).astype("<u4"), context.astype("<u4"), n.astype("<i8"))


def merged_pairs(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``merged`` of packed pairs."""
    words, sizes, context, n = (np.concatenate(x) for x in zip(*(unpack(v, *PAIRS) for v in values), strict=True))
    return merged(words, np.repeat(np.arange(len(words)), sizes.astype(np.int64)), context, n)


COUNTED = "part bigint, sub int, pairs binary"


def _count(ranges: int, heavy: int):
    """Packed pairs of each range of words; pairs of words with ``heavy`` or more restaurants here go by ranges of restaurants."""

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        word, context = (np.concatenate(x) for x in zip(*held, strict=True))
        word, context, n = merged(word, np.arange(len(word)), context)
        cuts = _runs(word)
        large = np.repeat(np.diff(cuts) >= heavy, np.diff(cuts))
        sub = np.where(large, 1 + (context >> np.uint32(CONTEXT_BITS - 10)).astype(np.int32), 0)
        part = range_of(word, ranges)
        order = np.lexsort((sub, part)) if large.any() else np.arange(len(word))
        key = part[order] * 2048 + sub[order]
        cuts = _runs(key)
        rows = [(int(key[a]) // 2048, int(key[a]) % 2048, pack_pairs(word[order[a:b]], context[order[a:b]], n[order[a:b]])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["part", "sub", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                word, context, _ = tokens(texts[lo:hi])
                held.append((word, context))
                if sum(len(w) for w, _ in held) >= FLUSH_TOKENS:
                    yield from flush(held)
                    held = []
        if held:
            yield from flush(held)

    return run


def _merge_sub(table: pa.Table) -> pa.Table:
    pairs = merged_pairs(table.column("pairs").to_pylist())
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "pairs": pa.array([pack_pairs(*pairs)], pa.binary())})


STATE = "part bigint, n_tokens bigint, n_types bigint, ones bigint, twos bigint, one bigint, two bigint, pairs binary, tables binary, kept binary, parents binary"
NAMES = [c.split()[0] for c in STATE.split(", ")]


def _first_state(table: pa.Table) -> pa.Table:
    """A range's pairs with every dish at one table, and what the discounts need."""
    word, context, n = merged_pairs(table.column("pairs").to_pylist())
    cuts = _runs(word)
    c = np.add.reduceat(n, cuts[:-1]) if len(n) else n
    many = int((n > 1).sum())
    numbers = [table.column("part")[0].as_py(), int(n.sum()), len(c), int((n == 1).sum()), int((n == 2).sum()), int((c == 1).sum()), int((c == 2).sum())]
    blobs = [pack_pairs(word, context, n), pack(np.zeros(many, "<u4"), np.ones(len(c), "<u4")), pack(np.zeros(many, "<u4")), pack(np.zeros(0, "<u4"))]
    return pa.table({k: pa.array([v], t) for k, v, t in zip(NAMES, [*numbers, *blobs], [pa.int64()] * 7 + [pa.binary()] * 4, strict=True)})


@dataclass
class Range:
    """The pairs of a range of words, with the tables of each pair and of each word at the parent."""

    words: np.ndarray
    sizes: np.ndarray
    context: np.ndarray
    n: np.ndarray
    tables: np.ndarray
    parent_tables: np.ndarray

    @classmethod
    def of(cls, pairs: bytes, tables: bytes) -> Range:
        words, sizes, context, n = unpack(pairs, *PAIRS)
        extra, parent_tables = unpack(tables, "<u4", "<u4")
        t = np.ones(len(n), np.int64)
        t[n > 1] += extra
        return cls(words, sizes.astype(np.int64), context, n, t, parent_tables.astype(np.int64))

    def who(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.words)), self.sizes)

    def customers(self) -> np.ndarray:
        """The parent's customers of each word: its tables."""
        return np.bincount(self.who(), self.tables, len(self.words)).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Customers and tables of the restaurants, of one task, by ranges of restaurants."""
    customers, tables = np.zeros(RESTAURANTS, np.int64), np.zeros(RESTAURANTS, np.int64)
    for batch in batches:
        for pairs, state in zip(batch.column("pairs").to_pylist(), batch.column("tables").to_pylist(), strict=True):
            r = Range.of(pairs, state)
            np.add.at(customers, r.context, r.n)
            np.add.at(tables, r.context, r.tables)
    width = RESTAURANTS // SUM_RANGES
    for i in range(SUM_RANGES):
        mine = np.flatnonzero(customers[i * width: (i + 1) * width])
        if len(mine):
            value = pack(mine.astype("<u4"), customers[i * width + mine], tables[i * width + mine])
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([value], pa.binary())], ["range", "sums"])


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros((2, RESTAURANTS // SUM_RANGES), np.int64)
    for value in table.column("sums").to_pylist():
        at, customers, tables = unpack(value, "<u4", "<i8", "<i8")
        total[0, at] += customers
        total[1, at] += tables
    at = np.flatnonzero(total[0])
    return pa.table({"range": table.column("range").slice(0, 1), "sums": pa.array([pack(at.astype("<u4"), total[0, at], total[1, at])], pa.binary())})


def restaurant_sums(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of all restaurants: two arrays of a fixed size."""
    customers, tables = np.zeros(RESTAURANTS, np.int64), np.zeros(RESTAURANTS, np.int64)
    rows = state.select("pairs", "tables").mapInArrow(_sums, "range int, sums binary").groupBy("range").applyInArrow(_added, "range int, sums binary")
    for r in rows.toLocalIterator():
        at, c, t = unpack(r["sums"], "<u4", "<i8", "<i8")
        at = at + r["range"] * (RESTAURANTS // SUM_RANGES)
        customers[at], tables[at] = c, t
    return customers, tables


def log_stirling(d: float, most: int) -> np.ndarray:
    """log S(n, t) for n, t up to ``most``: S(n + 1, t) = S(n, t - 1) + (n - d t) S(n, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(most + 1)
    with np.errstate(divide="ignore"):
        for n in range(most):
            stay = out[n] + np.log(np.maximum(n - d * t, 0))
            out[n + 1] = stay
            out[n + 1, 1:] = np.logaddexp(stay[1:], out[n, :-1])
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function of positive numbers, by Stirling's series from 8 on."""
    x = np.atleast_1d(np.asarray(x, float))
    low = x < 8
    y = np.where(low, x + 8, x)
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    if low.any():
        v = x[low]
        out[low] -= np.log(v * (v + 1) * (v + 2) * (v + 3) * (v + 4) * (v + 5) * (v + 6) * (v + 7))
    return out


def _saddle(d: float, n: float, t: np.ndarray) -> np.ndarray:
    """log of the n-th coefficient of (1 - (1 - x)^d)^t by its saddle point."""
    low, high = np.full(len(t), -700.0), np.full(len(t), -1e-12)  # log(1 - x)
    for _ in range(60):
        mid = (low + high) / 2
        large = t * d * -np.expm1(mid) * np.exp((d - 1) * mid) / -np.expm1(d * mid) > n
        low, high = np.where(large, mid, low), np.where(large, high, mid)
    mid = (low + high) / 2
    x = -np.expm1(mid)
    curve = np.maximum(n * (1 + (1 - d) * x / np.exp(mid) - n / t), 1e-9)
    return t * np.log(-np.expm1(d * mid)) - n * np.log(x) - 0.5 * np.log(2 * np.pi * curve)


def _series(d: float, n: float, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same by the binomial series in (1 - x)^(d k), whose coefficients are gamma functions; and where its terms do not cancel out."""
    k = np.arange(1, int(min(t.max(), 250)) + 1, dtype=float)[None]
    t = t[:, None]
    size = np.where(k <= t, log_gamma(t + 1) - log_gamma(k + 1) - log_gamma(np.maximum(t - k, 0) + 1), -np.inf)
    size = size + log_gamma(n - d * k) - log_gamma(np.array([n + 1.0])) + log_gamma(1 + d * k)
    top = size.max(axis=1, keepdims=True)
    total = (np.exp(size - top) * np.where(k % 2 == 1, 1.0, -1.0) * np.sin(np.pi * d * k) / np.pi).sum(axis=1)
    sound = (total > 1e-5) & ((size[:, -1] < top[:, 0] - 30) | (k.max() >= t[:, 0]))
    return np.log(np.maximum(total, 1e-300)) + top[:, 0], sound


def log_stirling_large(d: float, n: float, t: np.ndarray) -> np.ndarray:
    """log S(n, t) - log n! for large n: the n-th coefficient of (1 - (1 - x)^d)^t / (t! d^t)."""
    t = np.asarray(t, float)
    out, sound = _series(d, n, t)
    if not sound.all():
        out[~sound] = _saddle(d, n, t[~sound])
    return out - log_gamma(t + 1) - t * np.log(d)


@dataclass
class Seats:
    """Conditionals of table counts: n customers of one dish in a restaurant of discount d.

    The i-th new table has probability (strength + d (others + i)), ``others`` being the restaurant's
    other tables, times what its parent gives the dish: (first, then start + i) / (all + i), or the
    constant ``base``, if there is no ``start``.
    """

    d: float
    stirling: np.ndarray
    n: np.ndarray
    others: np.ndarray
    first: np.ndarray
    start: np.ndarray | None = None
    all: np.ndarray | None = None

    def steps(self, rows: np.ndarray, width: int) -> np.ndarray:
        i = np.arange(width)[None]
        out = np.log(STRENGTH + self.d * (self.others[rows][:, None] + i)) + np.log(self.first[rows])[:, None]
        if self.start is not None:
            gain = np.log(np.maximum(self.start[rows][:, None] + i[:, 1:], 1e-300)) - np.log(self.first[rows])[:, None]
            out[:, 1:] += gain
            out -= np.log(self.all[rows][:, None] + i)
        return np.cumsum(out, axis=1)

    def closed(self, row: int, t: np.ndarray) -> np.ndarray:
        a = STRENGTH / self.d + self.others[row]
        out = t * np.log(self.d) + log_gamma(a + t) - log_gamma(a)
        if self.start is None:
            return out + t * np.log(self.first[row])
        start, total = self.start[row], self.all[row]
        return out + np.log(self.first[row]) + log_gamma(start + t) - log_gamma(start + 1) - log_gamma(total + t) + log_gamma(total)

    def drawn(self, u: np.ndarray) -> np.ndarray:
        """A table count per row, by inverting its distribution at ``u``."""
        out = np.ones(len(self.n), np.int64)
        low = 2
        while low <= EXACT:
            high = min(EXACT, low if low < 5 else low + low // 2)
            rows = np.flatnonzero((self.n >= low) & (self.n <= high))
            for at in range(0, len(rows), max(1, (1 << 21) // high)):
                some = rows[at: at + max(1, (1 << 21) // high)]
                weight = self.stirling[self.n[some], 1: high + 1] + self.steps(some, high)
                weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
                out[some] = 1 + (weight < (u[some] * weight[:, -1])[:, None]).sum(axis=1)
            low = high + 1
        for row in np.flatnonzero(self.n > EXACT):
            out[row] = self._large(int(row), float(u[row]))
        return np.minimum(out, self.n)

    def _large(self, row: int, u: float) -> int:
        n = int(self.n[row])
        grid = np.unique(np.geomspace(1, n, 48).astype(np.int64))
        for _ in range(4):  # closer and closer around the bulk
            weight = log_stirling_large(self.d, n, grid) + self.closed(row, grid)
            bulk = np.flatnonzero(weight > weight.max() - 25)
            low, high = int(grid[max(0, bulk[0] - 1)]), int(grid[min(len(grid) - 1, bulk[-1] + 1)])
            if high - low < 200:
                break
            grid = np.unique(np.linspace(low, high, 64).astype(np.int64))
        grid = np.unique(np.linspace(low, high, min(high - low + 1, 256)).astype(np.int64))
        weight = log_stirling_large(self.d, n, grid) + self.closed(row, grid)
        weight = np.cumsum(np.exp(weight - weight.max()))
        return int(grid[min(len(grid) - 1, int((weight < u * weight[-1]).sum()))])


@dataclass
class Totals:
    """What all types share after a sweep: the parent's customers and tables, and the parameters."""

    d: float
    parent_d: float
    n_types: int
    customers: float
    tables: float

    @property
    def fresh(self) -> float:
        """The parent's weight of a dish that it does not serve, before it is divided by ``all``."""
        return (STRENGTH + self.parent_d * self.tables) / (self.n_types + 1)

    @property
    def all(self) -> float:
        return STRENGTH + self.customers

    def parent(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The parent's probability of dishes with c customers at t tables there."""
        return (c - self.parent_d * t + self.fresh) / self.all

    def share(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """What each restaurant leaves to the parent."""
        return (STRENGTH + self.d * tables) / (STRENGTH + customers)


def uniforms(a: np.ndarray, b: np.ndarray, sweep: int) -> np.ndarray:
    """Numbers in [0, 1) that follow from two keys and the sweep."""
    return (mix64(a + mix64(b.astype(np.uint64) ^ mix64(np.array([sweep + 1], np.uint64) * _MIX))) >> np.uint64(11)).astype(float) / 2.0**53


def swept(r: Range, tables: np.ndarray, totals: Totals, stirling: tuple[np.ndarray, np.ndarray], sweep: int) -> Range:
    """One Gibbs sweep over a range: ``tables`` are the restaurants' tables before it."""
    who, t, pc, pt = r.who(), r.tables.copy(), r.customers(), r.parent_tables
    pairs = np.flatnonzero(r.n > 1)
    cuts = _runs(who[pairs])
    held = np.diff(cuts)
    rank = np.arange(len(pairs)) - np.repeat(cuts[:-1], held)
    turn = np.where(np.repeat(held, held) <= TURNS, rank, rank * TURNS // np.maximum(np.repeat(held, held), 1))
    u = uniforms(r.words[who[pairs]], r.context[pairs], sweep)
    for i in range(int(turn.max(initial=-1)) + 1):
        mine = np.flatnonzero(turn == i)
        p = pairs[mine]
        w = who[p]
        c = pc[w] - t[p]
        at = np.minimum(pt[w], c)
        served = c - totals.parent_d * at + totals.fresh
        # A dish that the parent does not serve yet gets its table there with the first customer.
        start = np.where(c > 0, served, totals.fresh - totals.parent_d)
        seats = Seats(totals.d, stirling[0], r.n[p], tables[r.context[p]].astype(float) - r.tables[p], np.where(c > 0, served, totals.fresh), start, totals.all - t[p])
        new = seats.drawn(u[mine])
        pc += np.bincount(w, new - t[p], len(pc)).astype(np.int64)
        t[p] = new
    shared = np.flatnonzero(pc > 1)
    at = np.ones(len(pc), np.int64)
    base = np.full(len(shared), 1 / (totals.n_types + 1))
    at[shared] = Seats(totals.parent_d, stirling[1], pc[shared], totals.tables - pt[shared].astype(float), base).drawn(uniforms(r.words[shared], np.zeros(len(shared)), sweep))
    return Range(r.words, r.sizes, r.context, r.n, t, at)


def _sweep(shared, totals: Totals, sweep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, stirling = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                r = swept(Range.of(row["pairs"], row["tables"]), tables, totals, stirling, sweep)
                many = r.n > 1
                row["tables"] = pack((r.tables[many] - 1).astype("<u4"), r.parent_tables.astype("<u4"))
                if sweep >= BURN_IN:
                    row["kept"] = pack(unpack(row["kept"], "<u4")[0] + (r.tables[many] - 1).astype("<u4"))
                    row["parents"] = pack(np.concatenate([unpack(row["parents"], "<u4")[0], r.customers().astype("<u4"), r.parent_tables.astype("<u4")]))
                yield pa.RecordBatch.from_pylist([row], batch.schema)

    return run


@dataclass
class Model:
    """``state``: a written row of packed pairs per range of words; the restaurants' customers and shares after each kept sweep."""

    state: DataFrame
    ranges: int
    n_tokens: int
    n_types: int
    customers: np.ndarray
    shares: list[np.ndarray]
    totals: list[Totals]

    def unknown(self) -> np.ndarray:
        return np.array([t.fresh / t.all for t in self.totals])


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def fit(train: DataFrame) -> Model:
    """Count all pairs of ``train`` (column ``text``), then sample ``BURN_IN + KEPT`` sweeps."""
    spark = train.sparkSession
    size, rows = train.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = (size or 0) + rows
    ranges = max(1, -(-size // RANGE_BYTES))
    # Words whose restaurants, over about as many flushes as there will be, might exceed a merge.
    heavy = max(256, MERGED // (1 + size // (6 * FLUSH_TOKENS)))
    counted = train.select("text").mapInArrow(_count(ranges, heavy), COUNTED)
    once = counted.groupBy("part", "sub").applyInArrow(_merge_sub, "part bigint, pairs binary")
    first = once.groupBy("part").applyInArrow(_first_state, STATE)
    # Two tables take turns: a sweep reads one and overwrites the other.
    paths = [scratch_path(spark, "lm-state") for _ in range(2)]

    def kept(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "none").option("maxRecordsPerFile", 1).parquet(path)
        return spark.read.schema(STATE).parquet(path)

    state = kept(first, paths[0])
    sums = state.agg(*[F.sum(c).alias(c) for c in NAMES[1:7]]).first()
    n_tokens, n_types, ones, twos, one, two = (x or 0 for x in sums)
    d, parent_d = _discount(ones, twos), _discount(one, two)
    customers, tables = restaurant_sums(state)
    totals = Totals(d, parent_d, n_types, float(tables.sum()), float(n_types))
    stirling = log_stirling(d, EXACT), log_stirling(parent_d, EXACT)
    shares, history = [], []
    for sweep in range(BURN_IN + KEPT):
        shared = spark.sparkContext.broadcast((tables, stirling))
        state = kept(state.mapInArrow(_sweep(shared, totals, sweep), STATE), paths[(sweep + 1) % 2])
        shared.destroy()
        _, tables = restaurant_sums(state)
        parents = state.select("tables").mapInArrow(_parent_tables, "n bigint").agg(F.sum("n")).first()[0] or 0
        totals = Totals(d, parent_d, n_types, float(tables.sum()), float(parents))
        if sweep >= BURN_IN:
            shares.append(totals.share(customers, tables).astype(np.float32))
            history.append(totals)
    return Model(state, ranges, n_tokens, n_types, customers.astype(np.float32), shares, history)


def _parent_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(unpack(v, "<u4", "<u4")[1].sum()) for v in batch.column("tables").to_pylist()], pa.int64())], ["n"])


class Lookup:
    """Counts and averaged probabilities of a range's words and pairs."""

    def __init__(self, row: dict, customers: np.ndarray, totals: list[Totals]):
        self.words, sizes, context, n = unpack(row["pairs"], *PAIRS)
        who = np.repeat(np.arange(len(self.words)), sizes.astype(np.int64))
        self.counts = np.bincount(who, n, len(self.words))
        mean = np.ones(len(n))
        mean[n > 1] += unpack(row["kept"], "<u4")[0] / KEPT
        self.keys = (who.astype(np.int64) << CONTEXT_BITS) | context
        self.own = (n - totals[0].d * mean) / (STRENGTH + customers[context])
        parents = unpack(row["parents"], "<u4")[0].astype(float).reshape(KEPT, 2, len(self.words))
        self.parents = np.array([t.parent(c, at) for t, (c, at) in zip(totals, parents, strict=True)])

    def only(self, word: int) -> Lookup:
        """The same for a single word."""
        out, i = object.__new__(Lookup), int(np.searchsorted(self.words, np.uint64(word)))
        lo, hi = np.searchsorted(self.keys, [i << CONTEXT_BITS, (i + 1) << CONTEXT_BITS])
        out.words, out.counts, out.parents = self.words[i: i + 1], self.counts[i: i + 1], self.parents[:, i: i + 1]
        out.keys, out.own = self.keys[lo:hi] - (i << CONTEXT_BITS), self.own[lo:hi]
        return out

    def of(self, words: np.ndarray, sizes: np.ndarray, context: np.ndarray, shares: list[np.ndarray], unknown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each word, and the probability of each of its tokens (``sizes`` of a word) in their restaurants."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        known = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        who = np.repeat(np.arange(len(words)), sizes)
        p = np.zeros(len(context))
        if known.any():
            key = (at[who] << CONTEXT_BITS) | context
            pair = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            p = np.where(known[who] & (self.keys[pair] == key), self.own[pair], 0.0)
        for s, share in enumerate(shares):
            parent = np.where(known, self.parents[s][at], unknown[s]) if len(self.words) else np.full(len(words), unknown[s])
            p += share[context] * (parent / len(shares))[who]
        return np.where(known, self.counts[at], 0.0) if len(self.words) else np.zeros(len(words)), p


SENT = "part bigint, unit bigint, tokens binary"


def _sent(ranges: int, hot: dict[int, tuple[int, int]]):
    """Packed tokens of each range of words, and the ids of the texts that they come from, under a number for each flush."""

    def flush(held: list[tuple], unit: int) -> Iterator[pa.RecordBatch]:
        word, context, per_text, ids, valid, held_out = (np.concatenate(x) for x in zip(*held, strict=True))
        doc = np.repeat(np.arange(len(per_text), dtype=np.uint32), per_text)
        rows = [(-1 - unit % ranges, pack(ids, valid, held_out, per_text.astype("<i8")))]
        order = np.argsort(word)
        word, context, doc = word[order], context[order], doc[order]
        part = range_of(word, ranges)
        for h, (base, salts) in hot.items():
            lo, hi = (np.searchsorted(word, np.uint64(h), side=side) for side in ("left", "right"))
            part[lo:hi] = base + unit % salts
        # Words are in order, and so are their ranges; a hot word's run stands between two runs of its range.
        cuts = _runs(part)
        pieces: dict[int, list[slice]] = {}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            pieces.setdefault(int(part[a]), []).append(slice(a, b))
        for p, own in pieces.items():
            w, c, at = (np.concatenate([x[i] for i in own]) if len(own) > 1 else x[own[0]] for x in (word, context, doc))
            runs = _runs(w)
            rows.append((p, pack(w[runs[:-1]], np.diff(runs).astype("<u4"), c, at)))
        for p, value in rows:
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([unit], pa.int64()), pa.array([value], pa.binary())], ["part", "unit", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        # A task that is run again gives its flushes the same numbers.
        unit = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), as_bytes(batch.column("text"))
            numbers, valid = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint8)
            for lo, hi in slices(texts):
                word, context, per_text = tokens(texts[lo:hi])
                held.append((word, context, per_text, numbers[lo:hi], valid[lo:hi], held_out[lo:hi]))
                if sum(len(h[0]) for h in held) >= FLUSH_TOKENS:
                    yield from flush(held, unit)
                    held, unit = [], unit + 1
        if held:
            yield from flush(held, unit)

    return run


PARTIAL = "unit bigint, ids boolean, sums binary"


def _scored(shared, hot: dict[int, tuple[int, int]], n_tokens: int, n_types: int):
    by_base = {base: word for word, (base, _) in hot.items()}

    def run(key: tuple, sent: pa.Table, models: pa.Table) -> pa.Table:
        customers, shares, totals, unknown = shared.value
        part, rows, lookup = key[0].as_py(), [], None
        if part >= 0:
            row = models.to_pylist()[0] if models.num_rows else None
            empty = {"pairs": pack(*(np.zeros(0, k) for k in PAIRS)), "kept": pack(np.zeros(0, "<u4")), "parents": pack(np.zeros(0, "<u4"))}
            lookup = Lookup(row or empty, customers, totals)
            bases = [b for b in by_base if b <= part]
            if bases:
                lookup = lookup.only(by_base[max(bases)])
        for unit, value in zip(sent.column("unit").to_pylist(), sent.column("tokens").to_pylist(), strict=True):
            if lookup is None:
                rows.append((unit, True, value))
                continue
            words, sizes, context, doc = unpack(value, "<u8", "<u4", "<u4", "<u4")
            sizes = sizes.astype(np.int64)
            c, p = lookup.of(words, sizes, context, shares, unknown)
            base, known = np.log10((c + 1) / (n_tokens + n_types + 1)), (c > 0).astype(float)
            sums = [np.bincount(doc, x) for x in (np.repeat(base, sizes), np.log10(p), np.repeat(known, sizes))]
            place = np.flatnonzero(np.bincount(doc))
            sums = [x[place] for x in sums]
            rows.append((unit, False, pack(place.astype("<u4"), sums[0], sums[1].astype("<f4"), sums[2].astype("<u4"))))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("unit", "ids", "sums"), columns, (pa.int64(), pa.bool_(), pa.binary()), strict=True)})

    return run


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _joined(table: pa.Table) -> pa.Table:
    """The rows of one flush: its texts' ids with all ranges' sums added up."""
    is_ids = table.column("ids").to_pylist()
    values = table.column("sums").to_pylist()
    ids, valid, held_out, n = unpack(next(v for v, own in zip(values, is_ids, strict=True) if own), "<i8", "u1", "u1", "<i8")
    total = np.zeros((3, len(ids)))
    # In one order, whatever order the shuffle brings them in.
    for value in sorted(v for v, own in zip(values, is_ids, strict=True) if not own):
        place, base, score, known = unpack(value, "<u4", "<f8", "<f4", "<u4")
        for row, x in zip(total, (base, score, known), strict=True):
            row[place] += x
    return pa.table({"doc_id": pa.array(ids, mask=valid == 0), "held_out": pa.array(held_out.astype(bool)), "n_tokens": pa.array(n),
                     "n_known": pa.array(total[2].astype(np.int64)), "base_score": pa.array(total[0]), "score": pa.array(total[1])})


def _hot_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c) of the words of at least HOT_TOKENS."""
    for batch in batches:
        for value in batch.column("pairs").to_pylist():
            words, sizes, _, n = unpack(value, *PAIRS)
            c = np.bincount(np.repeat(np.arange(len(words)), sizes.astype(np.int64)), n, len(words)).astype(np.int64)
            at = np.flatnonzero(c >= HOT_TOKENS)
            yield pa.RecordBatch.from_arrays([pa.array(words[at].view(np.int64)), pa.array(c[at])], ["word", "c"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, held_out, text)."""
    spark = docs.sparkSession
    hot, base = {}, model.ranges
    # At most one word in HOT_TOKENS tokens.
    for r in model.state.select("pairs").mapInArrow(_hot_words, "word bigint, c bigint").orderBy("word").collect():
        salts = -(-r["c"] // HOT_TOKENS)
        hot[r["word"] % (1 << 64)] = (base, salts)
        base += salts
    sent = docs.select("doc_id", "held_out", "text").mapInArrow(_sent(model.ranges, hot), SENT)
    rows = model.state.select("part", "pairs", "kept", "parents")
    if hot:
        words = np.array(list(hot), np.uint64)
        copies = [(int(p), b + i) for p, (b, n) in zip(range_of(words, model.ranges).tolist(), hot.values(), strict=True) for i in range(n)]
        more = F.broadcast(spark.createDataFrame(copies, "of bigint, copy bigint"))
        rows = rows.union(rows.join(more, F.col("part") == F.col("of")).select(F.col("copy").alias("part"), "pairs", "kept", "parents"))
    shared = spark.sparkContext.broadcast((model.customers, model.shares, model.totals, model.unknown()))
    run = _scored(shared, hot, model.n_tokens, model.n_types)
    partial = sent.groupBy("part").cogroup(rows.withColumnRenamed("part", "range").groupBy("range")).applyInArrow(run, PARTIAL)
    return partial.groupBy("unit").applyInArrow(_joined, SCORED)


def score_documents(docs: DataFrame) -> DataFrame:
    """All documents scored by a model of those whose CRC-32 remainder (mod 7) is not 2."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc32_text(F.col("doc_id")) % 7 == 2).alias("held_out"), "text")
    model = fit(rows.where(~F.col("held_out")))
    return score(rows, model).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
