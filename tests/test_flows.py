"""End-to-end jobs on the smallest driver data."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from parley.operators import prepare as P
from parley.plans import corpus as C
from parley.plans import flows as W
from tests.conftest import SF_SMALL


def test_prepare_bank_answer_encode(spark):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw = C.corpus(spark, SF_SMALL).withColumn("flags", F.lit("B"))
    paths = W.prepare_corpus(raw, out)
    meta = json.loads(open([os.path.join(paths["metadata"], f) for f in os.listdir(paths["metadata"])
                            if f.endswith(".json")][0]).readline())
    n = meta["clean_size"]
    assert (meta["train_size"], meta["val_size"], meta["test_size"]) == P.split_counts(n)
    assert meta["raw_size"] == raw.count() and meta["columns"] == "input_text,target_text,category,intent"
    assert spark.read.parquet(paths["sample"]).count() == min(100, meta["train_size"])
    lines = spark.read.text(paths["sample_questions"]).collect()
    assert len(lines) == 10 and lines[0]["value"].startswith("1. ")
    summary = [r["value"] for r in spark.read.text(paths["dataset_summary"]).collect()]
    assert f"shape: rows: {raw.count()}" in summary and "shape: columns: 8" in summary
    assert spark.read.json(paths["length_histogram"]).count() == 100

    bank = W.build_and_save_bank(spark, paths["processed"], os.path.join(out, "bank"))
    assert bank.count() == spark.read.parquet(paths["processed"]).where("split = 'train'").select("intent").distinct().count()
    qs = C.questions(spark, SF_SMALL)
    ans = W.answer_saved(qs, os.path.join(out, "bank"))
    assert ans.count() == qs.count()

    enc = W.encode_corpus(spark, paths["processed"], os.path.join(out, "enc"))
    assert {r["split"] for r in enc.select("split").distinct().collect()} == {"train", "val"}
    assert enc.where(F.size("input_ids") != 128).count() == 0 and enc.where(F.size("labels") != 512).count() == 0
    enc_s = W.encode_corpus(spark, paths["processed"], os.path.join(out, "enc_s"), use_sample=paths["sample"])
    assert enc_s.where("split = 'train'").count() == min(100, meta["train_size"])

    battery = W.evaluate_battery(qs, bank, keys=("conv_id", "turn")).collect()
    assert len(battery) == 19 and sum(r["model_prompt"] is not None for r in battery) == 5
