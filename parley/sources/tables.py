"""Driver tables and the support-corpus stand-ins built from them.

The original corpus (instruction, response, category, intent, flags) is not
available; these functions derive tables of the same shape from the given
parquet tables, so every plan grows with its input.

* ``document_corpus``: one row per document.  ``instruction`` = first line of
  the text, ``response`` = the whole text, ``category`` = upper-case language,
  ``intent`` = source.  Exact duplicate documents give duplicate pairs; near
  copies give equal instructions with different responses.

* ``user_questions``: user turns as questions to answer, keyed by
  ``(conv_id, turn)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_line

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_corpus(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("id"),
        first_line("text").alias("instruction"),
        F.col("text").alias("response"),
        F.upper("lang").alias("category"),
        F.col("source").alias("intent"),
    )


def user_questions(conversations: DataFrame) -> DataFrame:
    return (conversations.where(F.col("role") == "user")
            .select("conv_id", "turn", F.col("text").alias("query")))
