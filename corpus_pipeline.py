"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of documents.

Defined results
* extra columns stay with their rows through all stages but the last, whatever they are called
* null, empty and letterless texts are in no language: the first stage drops them
* repeated rows and equal texts are near copies; of a class the rows of the smallest doc_id stay,
  and so do all rows without an id
* a very long text is handled whole by every stage; packing cuts it into pieces
* ties: the language that sorts first, the smallest doc_id, the first domain by name
* an empty table goes through every stage and packs to no rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerweb.llm import langid, minhash, mixing, packing, substring
from ledgerweb.llm.common import cut, release, scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the others go."""
    return langid.language_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.near_duplicate_stage(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated passages."""
    return substring.substring_stage(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the domains ask for."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixing_stage(docs, mixing.domains_of(labels))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row for each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing_weights),
    ("packing", best_fit_packing),
]

#: Banded alignment, naive Bayes and tokenization have no SQL; tests/llm/test_edges.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch() as kept:  # what a stage wrote on its way goes when its result is there
            done = cut(stage(spark, docs, sf_dir), name)
            kept.append(done)
        release(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
