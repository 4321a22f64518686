"""The registered queries of this subpackage; ``ORACLES`` has their DuckDB SQL, where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import archive, audit, codes, decontaminate, hpylm, neardup, packing, pii, quality, secrets, sharding, simhash, topk
from pulsegrid.llm.common import read_table
from pulsegrid.llm.oracles import ORACLES

SHARDS = 24


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.round_trip(read_table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), SHARDS)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_documents(read_table(spark, sf_dir, "documents"))


def op9_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(read_table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_decontamination, op3_warc_round_trip, op4_near_duplicates, op5_jump_shards,
    op6_personal_data, op7_quality, op8_language_model, op9_max_score, op10_packing,
    op11_filter_audit, op12_vector_codes, op13_simhash)}

__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]
