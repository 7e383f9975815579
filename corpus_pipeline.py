"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet below
``spark.checkpoint.dir`` and read back as the next one's documents.  All but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import decontaminate, near_dedup, packing, pii, quality_rules
from parley.llm.common import table, written
from parley.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    return quality_rules.keep_good(docs, quality_rules.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the least doc_id."""
    return near_dedup.drop_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    return pii.replace(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences of 1024."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("pii", personal_data),
    ("packing", packed),
]

#: Learned rules, sketches and token ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
