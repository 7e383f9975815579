"""End-to-end jobs, one per entry point of the original tool chain.

* ``prepare_corpus``  profile -> clean -> format -> split -> write (+ metadata,
  sample questions, 100-row sample, chart data)
* ``build_and_save_bank`` / ``answer_saved``  bank from the saved train split,
  questions answered against the saved bank
* ``encode_corpus``  vocabulary + fixed-length ids for train and val, saved per split
* ``evaluate_battery``  both answer paths for a sampled battery, as a result document

Every intermediate that several steps read is written once (below ``out_dir``,
which on a cluster should live in the shared ``spark.checkpoint.dir`` folder),
so each step reads files instead of recomputing the raw scan, de-duplication
and ranking, and a lost executor recomputes from those files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import (
    BATTERY_MODEL_PREFIX, SAMPLE_QUESTIONS, SAMPLE_TRAIN_ROWS, SEED, STOCK_LEXICON, TEST_SHARE, VAL_SHARE,
)
from ..functions.lexicon import Lexicon
from ..operators import bank as B
from ..operators import encode as E
from ..operators import prepare as P
from ..operators import profile as R
from ..operators import respond as A
from ..sources import files as IO


def prepare_corpus(raw: DataFrame, out_dir: str, keys: tuple[str, ...] = ("id",), seed: int = SEED,
                   test_size: float = TEST_SHARE, val_size: float = VAL_SHARE) -> dict[str, str]:
    """Entry A.  ``raw`` has ``instruction, response`` (+ ``category, intent``,
    extra columns such as ``flags``) and the key columns.  Returns output paths."""
    out = out_dir.rstrip("/")
    paths = {k: f"{out}/{k}" for k in (
        "dataset_summary", "category_counts", "intent_counts", "length_histogram", "length_stats",
        "sample_questions", "processed", "processed_csv", "metadata", "sample", "sample_csv")}
    spark = raw.sparkSession

    profiled = R.with_lengths(raw)
    IO.write_report(R.profile_report(profiled), paths["dataset_summary"])
    for c in ("category", "intent"):
        if c in raw.columns:
            R.value_counts(raw, c).write.mode("overwrite").json(paths[f"{c}_counts"])
    text_cols = [c for c in ("instruction", "response") if c in raw.columns]
    R.length_stats(raw, text_cols).coalesce(1).write.mode("overwrite").json(paths["length_stats"])
    R.length_histogram(raw, text_cols).coalesce(1).write.mode("overwrite").json(paths["length_histogram"])
    if "instruction" in raw.columns:
        sample = P.sample_n(raw, SAMPLE_QUESTIONS, seed, list(keys), pos_col="pos")
        IO.write_numbered_text(IO.numbered_lines(sample, "instruction", "pos"), paths["sample_questions"])

    # The cuts of the split are found before its labels, so the cleaned pairs are written once and
    # the split scans the files instead of de-duplicating again.
    cleaned = P.dedup_pairs(P.drop_missing(raw), keys=list(keys))
    P.format_pairs(cleaned, list(keys)).write.mode("overwrite").parquet(f"{out}/cleaned")
    formatted = spark.read.parquet(f"{out}/cleaned")
    split = P.with_split(formatted, P.split_cuts(formatted, list(keys), seed, test_size, val_size))
    IO.write_splits(split, paths["processed"])
    saved = spark.read.parquet(paths["processed"])
    IO.write_pairs_csv(saved, paths["processed_csv"])
    cols = [c for c in saved.columns if c not in (*keys, "split")]
    IO.write_json_rows(P.split_metadata(raw, saved, cols, {
        "train": f"{paths['processed']}/split=train", "val": f"{paths['processed']}/split=val",
        "test": f"{paths['processed']}/split=test"}), paths["metadata"])
    train = IO.scan_split(spark, paths["processed"], "train")
    sample = P.sample_n(train, SAMPLE_TRAIN_ROWS, seed, list(keys))
    sample.write.mode("overwrite").parquet(paths["sample"])
    IO.write_pairs_csv(spark.read.parquet(paths["sample"]).drop("split"), paths["sample_csv"])
    return paths


def build_and_save_bank(spark: SparkSession, processed: str, bank_path: str, seed: int = SEED,
                        keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Bank from the saved train split, written as JSON lines and read back."""
    train = IO.scan_split(spark, processed, "train")
    B.save_bank(B.template_bank(train, seed=seed, keys=list(keys)), bank_path)
    return B.read_bank(spark, bank_path)


def answer_saved(questions: DataFrame, bank_path: str, lexicon: Lexicon = STOCK_LEXICON,
                 text_col: str = "query", use_templates: bool = True) -> DataFrame:
    """Entry B over a batch: answer ``questions`` against a saved bank."""
    bank = B.read_bank(questions.sparkSession, bank_path)
    return A.answer_questions(questions, bank, lexicon, text_col, use_templates)


def encode_corpus(spark: SparkSession, processed: str, out: str, use_sample: str | None = None,
                  keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Entry C (data part): vocabulary over train (or the 100-row sample when
    ``use_sample`` names it), ids for train and val, written per split."""
    train = P.train_or_sample(IO.scan_split(spark, processed, "train"),
                              spark.read.parquet(use_sample).withColumn("split", F.lit("train"))
                              if use_sample else None, use_sample is not None)
    val = IO.scan_split(spark, processed, "val")
    vocab = E.build_vocabulary(train, ["input_text", "target_text"])
    vocab.write.mode("overwrite").parquet(f"{out.rstrip('/')}/vocab")
    vocab = spark.read.parquet(f"{out.rstrip('/')}/vocab")
    both = train.unionByName(val)
    enc = E.encode_pairs(both, vocab, list(keys), carry=["split"])
    IO.write_splits(P.select_features(enc, keys=[*keys, "split"]), f"{out.rstrip('/')}/encoded")
    return spark.read.parquet(f"{out.rstrip('/')}/encoded")


def evaluate_battery(questions: DataFrame, bank: DataFrame, n: int = 19, lexicon: Lexicon = STOCK_LEXICON,
                     keys: tuple[str, ...] = ("id",), seed: int = SEED, text_col: str = "query") -> DataFrame:
    """The validation battery: ``n`` sampled questions (1-based ``pos``),
    template path for all, model prompt for the first ``BATTERY_MODEL_PREFIX``
    (LIM-2)."""
    battery = P.sample_n(questions, n, seed, list(keys), pos_col="pos")
    sbs = A.side_by_side(battery, bank, lexicon, text_col)
    return sbs.withColumn("model_prompt", F.when(P.in_prefix(F.col("pos") - 1, BATTERY_MODEL_PREFIX),
                                                 F.col("model_prompt")))
