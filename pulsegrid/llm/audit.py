"""Interaction audit of five corpus filters over every order of applying them.

Filters A to D look at one text; E fails a document whose text equals that of
any smaller doc_id.  E is an existential self-join: a left-semi join of the
documents with the documents on hash, exact text and smaller doc_id.  A group of
copies is met by its smallest doc_id alone, which exists if any smaller one does,
so the join never looks through a group.

1. Hashes that more than one doc_id has are counted (narrow rows, pre-aggregated).
2. One pass over the texts tries A to D and keeps the text of rows with such a hash.
3. The semi-join marks E.  A hash with many rows is dealt over as many salts as it
   has thousands of rows; its representative goes to each of them.
4. The ids that E marked are united with the ids of the other failures; the bits
   of an id are joined with OR and counted per part, combination and label.
5. The at most 32 combinations of a part give all 120 orders by sums.

Edge cases: a NULL text is the empty text; a NULL doc_id is neither smaller nor
larger than another, so its row never fails E and makes none fail; rows of one
doc_id do not make each other fail; repeated rows count each; a NULL source is the
part ''; a doc_id with several label rows counts as good (toxic) if one of them says
so, and a NULL doc_id has no label; an empty table gives no rows; other columns, and
their names, are not used.  A very long text is read in blocks: what it needs
besides itself is one block's words and its distinct words.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import BLOCK_BYTES, as_bytes, bounded, word_blocks, written

FILTERS = "ABCDE"
SAME = 1 << FILTERS.index("E")
#: Rows of a group of copies that share a salt.
SALT_ROWS = 1000
#: Rows (12 bytes each) of the shared hashes that a broadcast may have; beyond, a shuffle join.
BROADCAST_ROWS = 1_000_000

_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_BLANKS = bytes.maketrans(bytes(range(9, 14)), b" " * 5)


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text; words are runs of anything but ASCII space and \\x09-\\x0D."""
    if len(text) <= BLOCK_BYTES:
        words = text.split()
        return len(words), len(set(words))
    n, seen = 0, set()
    for words in word_blocks(text.translate(_BLANKS)):
        n += len(words)
        seen.update(words)
    return n, len(seen)


def text_bits(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text of so many code points fails."""
    n, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * points, len(text.translate(None, _MARKS)) < len(text))
    return sum(1 << i for i, bad in enumerate(fails) if bad)


TRIED = "doc_id bigint, part string, hash bigint, salts int, body string, bits int"


def _tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, salts = batch.column("body"), batch.column("salts")
        points = pc.utf8_length(texts).to_pylist()
        bits = [text_bits(t, n) for t, n in zip(as_bytes(texts), points, strict=True)]
        shared = pc.if_else(pc.is_valid(salts), texts, pa.scalar(None, texts.type))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("hash"), salts, shared, pa.array(bits, pa.int32())],
            ["doc_id", "part", "hash", "salts", "body", "bits"])


def tried_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A written row per document: its number, id, part, failed bits of A to D, and the text where its hash is shared."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("hash", F.xxhash64("body"))
    shared = rows.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    shared = written(shared.select("hash", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")), "audit-shared")
    rows = rows.join(bounded(shared, BROADCAST_ROWS), "hash", "left").select("doc_id", "part", "hash", "salts", "body")
    return written(rows.mapInArrow(_tried, TRIED).withColumn("row", F.monotonically_increasing_id()), "audit-rows")


def marked_copies(rows: DataFrame) -> DataFrame:
    """(row) of the rows whose text a smaller doc_id has."""
    left = rows.where("body is not null").select("row", "doc_id", "hash", "body", "salts", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int").alias("salt"))
    first = left.groupBy("hash", "body").agg(F.min("doc_id").alias("first"), F.max("salts").alias("salts"))
    right = first.select(F.col("hash").alias("r_hash"), F.col("body").alias("r_body"), "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("r_salt"))
    return left.join(right, (F.col("hash") == F.col("r_hash")) & (F.col("salt") == F.col("r_salt")) & (F.col("body") == F.col("r_body"))
                     & (F.col("first") < F.col("doc_id")), "left_semi").select("row")


def combinations(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, bits, n, good, toxic): documents of each part and combination of failed filters."""
    failures = (rows.where("bits > 0").select("row", "bits")
                .union(marked_copies(rows).select("row", F.lit(SAME).alias("bits"))))
    # Every row once, with no bits, so that clean ones are counted too.
    named = rows.select("row", "doc_id", "part", F.lit(0).alias("bits")).unionByName(failures, allowMissingColumns=True)
    per_row = named.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("part").alias("part"), F.bit_or("bits").alias("bits"))
    # A hot id is a few rows before the labels are joined.
    counted = per_row.groupBy("doc_id", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col(key).cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))

    def total(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(F.lit(0))).alias(flag)

    return counted.join(known, "doc_id", "left").groupBy("part", "bits").agg(F.sum("n").alias("n"), total("good"), total("toxic"))


def steps() -> list[dict]:
    """All steps of all orders: the step's own bit, and the bits of the filters before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append({"filter_order": "".join(order), "step": i, "bit": bit, "before": before})
            before |= bit
    return out


def order_table(combos: DataFrame) -> DataFrame:
    """One row per part, order and step, from the at most 32 combinations of each part."""
    held = combos.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("held"))
    all_steps = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    rows = held.select("part", "held", F.explode(all_steps).alias("s")).select("part", "held", "s.*")
    bit, before = F.col("bit"), F.col("before")
    orders = len(list(permutations(FILTERS)))

    def total(where, value=lambda c: c["n"]) -> Column:
        return F.aggregate("held", F.lit(0).cast("long"), lambda a, c: a + F.when(where(c["bits"]), value(c)).otherwise(F.lit(0)).cast("long"))

    fails = lambda b: b.bitwiseAND(bit) != 0
    here = lambda b: fails(b) & (b.bitwiseAND(before) == 0)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda b: b.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda b: fails(b) & (b.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda b: b == bit).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        # A document that fails k filters is removed by each of them in a k-th of the orders.
        total(fails, lambda c: c["n"] * F.floor(F.lit(orders) / F.bit_count(c["bits"]))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return order_table(combinations(tried_rows(docs), labels))
