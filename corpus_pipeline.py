"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's result as Parquet below the shared
checkpoint folder and reads it again as the next one's input.

No SQL can state the fitted classifier's decisions, so ``ORACLE_SQL`` is None.
The tests hold the near-duplicate, decontamination and secret stages against
brute force, the quality stage against its operator's report, packing against its input,
and ``run`` against the chain of these, on small tables.

In every stage a NULL text counts as the empty text and stays NULL where the row stays,
repeated rows and rows without an id are rows of their own, ties do not change which rows
stay, long texts are read whole, an empty table gives no rows, and further columns come
through whatever their names (all but packing, which returns pieces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, neardup, packing, quality, secrets
from pulsegrid.llm.common import read_table, written
from pulsegrid.llm.queries import tokenizer_path

ORACLE_SQL = None
#: Words of a shingle of the near-duplicate stage (op4's own contract says 4).
NEAR_WORDS = 5


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no stage's results use, and the new name of each column."""
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(new).alias(old) for old, new in names.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of at least its threshold).

    Rows of one text have one score, so all stay or all go; an empty text is scored like any other.
    """
    weights = quality.fit(docs, read_table(spark, sf_dir, "labels"), lambda c: ~quality.is_held_out(c))
    rows, names = shielded(docs)
    return restored(quality.score(rows, weights, names["text"]).where("predicted = 1"), names)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id (NULL last).

    Rows of one doc_id, or of none, are as apart as their texts are.  A row without words is its own group.
    """
    row = next(name for name in (f"_row{i}" for i in range(len(docs.columns) + 1)) if name.lower() not in map(str.lower, docs.columns))
    # The numbers are written, so that both readings of the documents see the same ones.
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    kept = neardup.NearDuplicates(rows, shingle=NEAR_WORDS, row=row).kept_rows()
    return rows.join(kept.withColumnRenamed("row", row), row, "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; a text without words has none and stays."""
    rows, names = shielded(docs)
    hits = decontaminate.scan(rows, read_table(spark, sf_dir, "benchmark"), names["text"])
    return restored(hits.where(F.size("hit_ranges") == 0), names)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in a text replaced by a mark; n_chars follows the new text.

    Overlapping secrets become one mark; a row without secrets, or without a text, stays as it is.
    """
    _, findings = secrets.scan_step(docs.select("text"), *secrets.empty_ledger(docs))
    rows, names = shielded(docs)
    rows = secrets.at_paths(rows, findings, text=names["text"])
    clean = secrets.redacted(F.col(names["text"]), F.col("found"))
    changed = F.coalesce(F.size("found"), F.lit(0)) > 0
    out = {names["text"]: clean}
    if "n_chars" in names:
        size = F.length(clean).cast(docs.schema["n_chars"].dataType)
        out[names["n_chars"]] = F.when(changed, size).otherwise(F.col(names["n_chars"]))
    return restored(rows.withColumns(out), names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences; an empty text is its end id alone, repeated rows are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
