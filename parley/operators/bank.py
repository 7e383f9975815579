"""Response bank: per-intent lists of sampled responses, kept as a table
``(intent string, templates array<string>)``.

Each list is bounded (``per_intent`` / ``general_size`` entries), so
``collect_list`` never gathers an unbounded group: the sampling window runs
first and WindowGroupLimit trims every group to ``n`` rows in each map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (
    BANK_GENERAL_SIZE, BANK_PER_INTENT, DEFAULT_BANK_TEMPLATES, FALLBACK_INTENT, SEED,
)
from ..sources.files import path_kind
from .prepare import sample_n, sample_per_group

BANK_SCHEMA = T.StructType([
    T.StructField("intent", T.StringType(), True),
    T.StructField("templates", T.ArrayType(T.StringType(), True), True),
])


def _ordered_list(rank: str, text: str) -> F.Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t")))),
                       lambda s: s["t"])


def template_bank(train: DataFrame, text_col: str = "target_text", intent_col: str = "intent",
                  per_intent: int = BANK_PER_INTENT, seed: int = SEED,
                  keys: Sequence[str] = ("id",)) -> DataFrame:
    """RSP-1 (and RSP-2 when ``intent_col`` is absent): up to ``per_intent``
    responses per non-null intent, in sample order."""
    if intent_col not in train.columns:
        return general_bank(train, text_col, seed=seed, keys=keys)
    sampled = sample_per_group(train.select(*keys, intent_col, text_col), intent_col, per_intent,
                               seed, keys, rank_col="_r")
    return (sampled.groupBy(F.col(intent_col).alias("intent"))
            .agg(_ordered_list("_r", text_col).alias("templates")))


def general_bank(train: DataFrame, text_col: str = "target_text", size: int = BANK_GENERAL_SIZE,
                 seed: int = SEED, keys: Sequence[str] = ("id",)) -> DataFrame:
    """RSP-2: one ``general`` entry with up to ``size`` sampled responses."""
    sampled = sample_n(train.select(*keys, text_col), size, seed, keys, pos_col="_r")
    return (sampled.groupBy(F.lit(FALLBACK_INTENT).alias("intent"))
            .agg(_ordered_list("_r", text_col).alias("templates")))


def default_bank(spark: SparkSession) -> DataFrame:
    """RSP-3: the fixed ``general`` entry used when the training file cannot be read."""
    return spark.createDataFrame([(FALLBACK_INTENT, list(DEFAULT_BANK_TEMPLATES))], BANK_SCHEMA)


def empty_bank(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BANK_SCHEMA)


def load_bank(spark: SparkSession, train_path: str, on_missing: str = "empty", **kw) -> DataFrame:
    """Bank from a saved training split (Parquet), on any file system.

    A missing path gives the empty bank (every question goes to the model) or,
    with ``on_missing='default'``, the default bank; a path that is there but
    is no Parquet table gives the default bank, as the original does on a read
    error.  Other errors (no access, no such store) are raised.
    """
    if path_kind(spark, train_path) is None:
        return default_bank(spark) if on_missing == "default" else empty_bank(spark)
    try:
        train = spark.read.parquet(train_path)
    except (PySparkException, Py4JJavaError) as e:
        # no Parquet file below the path, or one whose footer is broken; anything else is raised
        if not any(x in str(e) for x in ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")):
            raise
        return default_bank(spark)
    return template_bank(train, **kw)


def save_bank(bank: DataFrame, path: str) -> None:
    """SNK-6 (bank part): the bank as JSON lines ``{"intent":..., "templates":[...]}``."""
    bank.write.mode("overwrite").json(path)


def read_bank(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BANK_SCHEMA).json(path)


def bank_as_text(bank: DataFrame, sep: str = " || ") -> DataFrame:
    """Flat form for comparison and JSON: ``(intent, n_templates, templates_text)``."""
    return bank.select("intent", F.size("templates").cast("bigint").alias("n_templates"),
                       F.array_join("templates", sep).alias("templates_text"))
