"""Near-duplicate documents: banded MinHash with sequential Bayesian verification.

1. One Arrow pass per document: distinct shingle hashes, a 128-bit id of the
   whole set, ``BANDS * ROWS`` minima, and one key per band.
2. Documents with equal sets are one class (copies never become pairs).
3. Classes that share a band key are candidates.  A bucket does not emit its
   pairs: each member meets the bucket's most central member (the class with
   the most shared buckets), which joins almost every group; a second round
   takes the pairs of a bucket that are still in different components.
   Pairs inside a component need no test, as they change nothing.  The second
   round meets on the rarest shingles of those open classes: a pair that
   reaches the threshold shares one of the first few in order of frequency (an
   exact prefix filter), while a large group's outsiders, whose rarest shingles
   are their own, meet almost no one.
4. A candidate's signatures are compared in batches.  After n comparisons with
   m matches the posterior of the similarity (uniform prior) gives the chance
   that it reaches the threshold; a pair is pruned when that falls below the
   chosen miss probability.
5. Survivors are verified exactly on the full shingle sets.
6. Components come from the verified links (large-star / small-star rounds on
   DataFrames, each written to the shared folder).

With 36 bands of 5 rows a pair at similarity 0.8 shares no band with
probability (1 - 0.8^5)^36 < 1e-6; all above is exact but for that and the
chosen miss probability.

Edge cases: a NULL, empty or blank text has an empty set and links with
nothing; a text of fewer words than a shingle is one shingle; repeated rows and
ties on the key fall in one class; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import HOT_ROWS, SPACE_WORDS, as_bytes, bounded, hash_words, met, mix64, slices, written

BANDS, ROWS = 36, 5
#: Signature comparisons in one batch of the sequential test.
BATCH = 20
#: Rows of the small side that a broadcast may have (16 bytes each); beyond, a shuffle join.
BROADCAST_ROWS = 1_000_000
#: Buckets or shingles (up to 100 bytes each) that a broadcast may have; beyond, only those with very many classes are.
MET_ROWS = 500_000
#: Classes of a shingle that meet another block of as many in one place.
BLOCK_CLASSES = 256

_RNG = np.random.default_rng(11)
_SCALE = _RNG.integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RNG.integers(1, 2**63, ROWS, dtype=np.uint64)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles (all words as one, if fewer)."""
    if not len(words):
        return words
    size = min(n, len(words))
    step = np.uint64(0x9FB21C651E98DF25)
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * step + words[i: len(words) - size + 1 + i]
    return np.unique(mix64(out))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MinHash signature of a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(low, (x[i: i + 1024] * _SCALE + _SHIFT).min(axis=0), out=low)
    return low


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = (signature.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64)
    return mix64(rows + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def fewest_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n comparisons, fewer than m matches mean P(similarity >= threshold) < miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose tail above
    t is the chance that a Binomial(n + 1, t) is at most m.
    """
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, bands array<bigint>, signature binary"


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                words, counts = hash_words(texts[lo:hi], SPACE_WORDS)
                sizes, ids, bands, signatures, at = [], [], [], [], 0
                for c in counts:
                    s = shingle_set(words[at: at + c], n)
                    at += c
                    sizes.append(len(s))
                    if len(s):
                        low = minima(s)
                        ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                        bands.append(band_keys(low))
                        signatures.append((low & np.uint32(0xFFFF)).astype("<u2").tobytes())
                    else:
                        ids.append(None), bands.append(None), signatures.append(None)
                part = batch.slice(lo, hi - lo)
                given = [c for c in ("row",) if c in batch.schema.names]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary()), *(part.column(c) for c in given)],
                    ["doc_id", "text_hash", "n_shingles", "set_id", "bands", "signature", *given])
    return run


def _shingles(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = batch.column("cid").to_numpy()
            texts = as_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                words, counts = hash_words(texts[lo:hi], SPACE_WORDS)
                ends = np.cumsum(counts)
                sets = [shingle_set(words[e - c: e], n) for c, e in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(cids[lo:hi], [len(x) for x in sets])), pa.array(np.concatenate(sets).view(np.int64))], ["cid", "shingle"])
    return run


def _prune(steps: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                a, b = (np.frombuffer(b"".join(as_bytes(part.column(c))), "<u2").reshape(-1, BANDS * ROWS) for c in ("sig_a", "sig_b"))
                alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
                for n, least in steps:
                    matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
                    keep = matches >= least
                    alive, matches, done = alive[keep], matches[keep], n
                yield pa.RecordBatch.from_arrays([part.column("a").take(pa.array(alive)), part.column("b").take(pa.array(alive))], ["a", "b"])
    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            ids, left, right = batch.column("a").to_pylist(), as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
            good = []
            for i, a in enumerate(ids):
                if last[0] != a:
                    last = (a, shingle_set(hash_words([left[i]], SPACE_WORDS)[0], n))
                other = shingle_set(hash_words([right[i]], SPACE_WORDS)[0], n)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                if 100 * both >= percent * (len(last[1]) + len(other) - both):
                    good.append(i)
            rows = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], ["a", "b"])
    return run


class NearDuplicates:
    """The stages of one run, over written tables; ``members()`` is the result.

    ``docs`` needs an integer ``doc_id`` and a ``text`` column; rename others first.
    ``row`` names a column of unique numbers, if the caller has one; ``kept_rows()`` are in its terms.
    """

    def __init__(self, docs: DataFrame, shingle: int = 4, percent: int = 80, miss: float = 1e-6, row: str | None = None):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
        self.shingle, self.percent = shingle, percent
        self.steps = fewest_matches(percent / 100, miss)
        if row is None:
            signed = self.docs.mapInArrow(_sign(shingle), SIGNED).withColumn("row", F.monotonically_increasing_id())
        else:
            signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"), F.col(row).cast("long").alias("row")).mapInArrow(_sign(shingle), f"{SIGNED}, row bigint")
        self.signed = written(signed, "nd-signed")
        first = F.min_by(F.struct(F.col("row").alias("cid"), "doc_id", "text_hash", "n_shingles", "bands", "signature"), F.struct("doc_id", "row"))
        grouped = self.signed.where("set_id is not null").groupBy("set_id").agg(first.alias("r")).select("set_id", "r.*")
        self.classes = written(grouped, "nd-classes")
        self._components: DataFrame | None = None

    def entries(self) -> DataFrame:
        """(band, cid, n) of the buckets that hold more than one class, with the bucket's size."""
        rows = self.classes.select(F.explode("bands").alias("band"), "cid", F.col("n_shingles").alias("n"))
        shared = written(rows.groupBy("band").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "nd-shared")
        return met(rows, shared, ["band"], MET_ROWS, HOT_ROWS)

    def _size_fits(self, a: str, b: str):
        return (F.col(a) * 100 >= F.col(b) * self.percent) & (F.col(b) * 100 >= F.col(a) * self.percent)

    def texts(self, cids: DataFrame) -> DataFrame:
        """(cid, text) of the classes named, from one of their documents, as a written table."""
        where = written(self.classes.select("cid", "doc_id", "text_hash").join(cids, "cid", "left_semi"), "nd-needed")
        same = [self.docs[c].eqNullSafe(F.col(f"w_{c}")) for c in ("doc_id", "text_hash")]
        side = bounded(where.toDF("cid", "w_doc_id", "w_text_hash"), BROADCAST_ROWS)
        return written(self.docs.join(side, same[0] & same[1]).select("cid", "text").dropDuplicates(["cid"]), "nd-texts")

    def links(self, pairs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """The pairs (a, b) of classes that truly reach the threshold, as a written table."""
        signatures = self.classes.select("cid", "signature")
        both = (pairs.join(signatures.toDF("a", "sig_a"), "a").join(signatures.toDF("b", "sig_b"), "b"))
        alive = written(both.mapInArrow(_prune(self.steps), "a bigint, b bigint"), "nd-alive")
        if texts is None:
            texts = self.texts(alive.select(F.col("a").alias("cid")).union(alive.select("b")).distinct())
        full = (alive.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")).sortWithinPartitions("a")
        return written(full.mapInArrow(_verify(self.shingle, self.percent), "a bigint, b bigint"), "nd-links")

    def star_pairs(self, entries: DataFrame) -> DataFrame:
        """Each class with the most central other member of each of its buckets."""
        weight = entries.groupBy("cid").agg(F.sum("held").alias("weight"))
        weighed = entries.join(weight, "cid")
        lead = weighed.groupBy("band").agg(F.max(F.struct("weight", (-F.col("cid")).alias("cid"), "n")).alias("l"), F.max("held").alias("held")).select(
            "band", "held", (-F.col("l.cid")).alias("lead"), F.col("l.n").alias("lead_n"))
        pairs = met(entries.drop("held"), written(lead, "nd-leads"), ["band"], MET_ROWS, HOT_ROWS).where((F.col("cid") != F.col("lead")) & self._size_fits("n", "lead_n"))
        return pairs.select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).distinct()

    def open_entries(self, entries: DataFrame, labels: DataFrame) -> DataFrame:
        """(band, cid, n, comp, low) of the buckets that hold more than one component; ``low`` is the bucket's least n."""
        marked = entries.select("band", "cid", "n").join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        split = marked.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("low"), F.count(F.lit(1)).alias("held")).where("lo < hi")
        split = written(split.select("band", "low", "held"), "nd-split")
        return written(met(marked, split, ["band"], MET_ROWS, HOT_ROWS).drop("held"), "nd-open")

    def rest_pairs(self, opened: DataFrame, texts: DataFrame, tested: DataFrame) -> DataFrame:
        """Candidates among the open classes, in different components and not tested yet.

        At t percent a pair needs (100 + t) * common >= t * (n_a + n_b).  A class
        of n shingles whose partners have at least ``low`` needs so many in common
        that one of its first n - common + 1 shingles, rarest first, is shared; and after the
        first shared one both sides must have enough left.
        Of the classes that meet at a shingle, only those outside the largest
        component there look for partners.  They and all classes there are dealt into blocks of
        ``BLOCK_CLASSES``, and block meets block, so that no task gets a whole hot shingle.
        """
        t = self.percent
        shingles = written(texts.mapInArrow(_shingles(self.shingle), "cid bigint, shingle bigint"), "nd-shingles")
        info = opened.groupBy("cid").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.min("low").alias("low"))
        low = F.greatest("low", F.ceil(F.col("n") * t / 100))
        info = info.select("cid", "n", "comp", (F.col("n") - F.ceil((F.col("n") + low) * t / (100 + t)) + 1).alias("prefix"))
        shared = written(shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "nd-frequent")
        df = F.coalesce("held", F.lit(1))
        rank = F.row_number().over(Window.partitionBy("cid").orderBy(df, "shingle"))
        rows = met(shingles, shared, ["shingle"], MET_ROWS, HOT_ROWS, "left").withColumn("rank", rank).join(info, "cid").where("rank <= prefix and held > 1")
        # What is left from here on, this shingle included: a bound on what is shared if it is the first in common.
        rows = written(rows.select("shingle", "cid", "n", "comp", (F.col("n") - F.col("rank") + 1).alias("rest")), "nd-prefixes")
        sizes = rows.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("size"))
        main = sizes.groupBy("shingle").agg(
            F.max_by("comp", F.struct("size", "comp")).alias("main"), F.sum("size").alias("held"), F.max("size").alias("most"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
        main = written(main.select("shingle", "main", "held", F.ceil(F.col("held") / BLOCK_CLASSES).cast("int").alias("blocks"),
                                   F.ceil((F.col("held") - F.col("most")) / BLOCK_CLASSES).cast("int").alias("outer_blocks")), "nd-main")
        rows = met(rows, main, ["shingle"], MET_ROWS, HOT_ROWS)

        def dealt(side: str, own: str, other: str) -> DataFrame:
            block, everywhere = F.pmod(F.xxhash64("cid"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
            at = (block.alias("at_a"), everywhere.alias("at_b")) if side == "a" else (everywhere.alias("at_a"), block.alias("at_b"))
            return rows.where("comp != main" if side == "a" else "true").select("shingle", *at, *[F.col(c).alias(f"{c}_{side}") for c in ("cid", "n", "comp", "rest", "main")])

        pairs = dealt("a", "outer_blocks", "blocks").join(dealt("b", "blocks", "outer_blocks"), ["shingle", "at_a", "at_b"]).where(
            (F.least("rest_a", "rest_b") * (100 + t) >= (F.col("n_a") + F.col("n_b")) * t) &
            (F.col("comp_a") != F.col("comp_b")) & ((F.col("comp_b") == F.col("main_b")) | (F.col("cid_a") < F.col("cid_b"))) & self._size_fits("n_a", "n_b"))
        pairs = pairs.select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b")).distinct()
        return pairs.join(tested, ["a", "b"], "left_anti")

    def components(self) -> DataFrame:
        """(cid, comp) of all classes that have links."""
        if self._components is None:
            entries = written(self.entries(), "nd-entries")
            star = written(self.star_pairs(entries), "nd-star")
            first = self.links(star)
            opened = self.open_entries(entries, connected(first))
            texts = self.texts(opened.select("cid").distinct())
            second = self.links(written(self.rest_pairs(opened, texts, star), "nd-rest"), texts)
            self._components = connected(first.union(second))
        return self._components

    def members(self) -> DataFrame:
        """(doc_id, text_hash, n_shingles, component_id) of every input row."""
        comp = self.classes.join(self.components(), "cid", "left").select("set_id", "doc_id", F.coalesce("comp", "cid").alias("comp"))
        least = comp.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        named = written(comp.drop("doc_id").join(least, "comp").select("set_id", "component_id"), "nd-named")
        full = self.signed.where("set_id is not null").join(named, "set_id")
        empty = self.signed.where("set_id is null").withColumn("component_id", F.col("doc_id"))
        cols = ["doc_id", "text_hash", "n_shingles", "component_id"]
        return full.select(*cols).union(empty.select(*cols))

    def kept_rows(self) -> DataFrame:
        """(row) of one row of each group: the smallest doc_id (NULL last), then the smallest row; every row without words."""
        comp = self.classes.join(self.components(), "cid", "left").select("set_id", F.coalesce("comp", "cid").alias("comp"))
        rows = self.signed.where("set_id is not null").select("set_id", "doc_id", "row").join(comp, "set_id")
        first = rows.groupBy("comp").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row"))
        return first.select("row").union(self.signed.where("set_id is null").select("row"))


def connected(links: DataFrame) -> DataFrame:
    """(cid, comp): the smallest id reachable over the undirected links (a, b).

    Alternates large-star and small-star rounds; both only join and take minima,
    so a hub with many links costs an aggregate, not a collected group.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = written(edges, "cc")
    state = None
    while True:
        # Large star: every larger neighbour of u moves to u's smallest neighbour.
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: u and its smaller neighbours move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).where("u > v").distinct()
        edges = written(small, "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("cid"), F.col("v").alias("comp")).union(edges.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    rows = NearDuplicates(docs, shingle, percent).members()
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
