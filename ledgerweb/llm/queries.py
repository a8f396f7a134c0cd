"""The registered queries of the operators and, where SQL can say them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, langid, minhash, mixing, packing, projections, quality, simhash, sstable, substring
from .oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_conversations(rows.unionByName(extra))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), mixing.domains_of(_table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.drop_repeats(_table(spark, sf_dir, "documents"), ["doc_id"])


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_sstable_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.round_trip(_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_language_id, op2_chat_formatting, op3_mixing, op4_substring_dedup, op5_minhash_near_dedup, op6_best_fit_packing, op7_quality_rules, op8_embedding_near_dedup, op9_sstable_output, op10_document_fingerprints)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
