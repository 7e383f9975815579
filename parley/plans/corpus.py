"""Shared plan fragments: the cleaned, split corpus and its bank.

Each fragment is a pure function of (spark, sf_dir) so every registered query
reads the given tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bank as B
from ..operators import prepare as P
from ..session import materialize
from ..sources.tables import document_corpus, table, user_questions


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """Raw stand-in corpus; single-line documents have no separate question
    (instruction null), which gives ``drop_missing`` real work."""
    c = document_corpus(table(spark, d, "documents"))
    return c.withColumn("instruction", F.when(F.col("instruction") != F.col("response"), F.col("instruction")))


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Null-free, de-duplicated pairs."""
    return P.dedup_pairs(P.drop_missing(corpus(spark, d)))


def split(spark: SparkSession, d: str) -> DataFrame:
    """(id, input_text, target_text, category, intent, split).

    The cuts are found before the labels, so the cleaned pairs are written
    once, as ``plans.flows.prepare_corpus`` does.
    """
    pairs = materialize(P.format_pairs(cleaned(spark, d)), "cleaned")
    return P.with_split(pairs, P.split_cuts(pairs))


def train(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d).where(F.col("split") == "train")


def bank(spark: SparkSession, d: str) -> DataFrame:
    return B.template_bank(train(spark, d))


def questions(spark: SparkSession, d: str) -> DataFrame:
    """User turns to answer, keyed (conv_id, turn)."""
    return user_questions(table(spark, d, "conversations"))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labelled text ``(idx, sentence, label)``: documents with a quality label."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("sentence"))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("idx"), F.col("quality").alias("label"))
    return docs.join(labels, "idx")
