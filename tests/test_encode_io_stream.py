"""Encoding invariants, file round trips, streaming vs batch, evaluation, classification."""

import json
import os
import tempfile
import tracemalloc

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.functions.constants import DEFAULT_QUESTIONS, LABEL_IGNORE_ID, PAD_ID
from parley.operators import encode as E
from parley.operators import evaluate as V
from parley.operators.bank import BANK_SCHEMA
from parley.sources import files as IO
from parley.streaming import chat as S


def _scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


# --- encoding ---------------------------------------------------------------------------------


def test_encoding_layout(spark):
    long = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, "Hello hello world", "the answer world"), (2, "", "  "), (3, None, long),
                                (4, "unseen zzz", "x")], "id bigint, input_text string, target_text string")
    vocab = E.build_vocabulary(df.where(F.col("id") != 4), ["input_text", "target_text"], size=20)
    v = {r["token"]: r["id"] for r in vocab.collect()}
    assert v["hello"] == 4 and min(v.values()) == 4 and len(v) == 16
    enc = {r["id"]: r for r in E.encode_pairs(df, vocab, ["id"], input_length=8, target_length=12).collect()}
    for r in enc.values():
        assert len(r["input_ids"]) == 8 and len(r["attention_mask"]) == 8 and len(r["labels"]) == 12
        assert sum(r["attention_mask"]) == sum(1 for x in r["input_ids"] if x != PAD_ID)
        assert PAD_ID not in r["labels"]
    assert enc[1]["input_ids"][:5] == [0, v["hello"], v["hello"], v["world"], 2]
    assert enc[2]["input_ids"] == [0, 2, 1, 1, 1, 1, 1, 1]
    assert enc[2]["labels"] == [0, 2] + [LABEL_IGNORE_ID] * 10
    assert enc[3]["labels"][-1] == 2 and len([x for x in enc[3]["labels"] if x != 0 and x != 2]) == 10
    assert enc[4]["input_ids"][:4] == [0, 3, 3, 2]


# --- files ---------------------------------------------------------------------------------------


def test_csv_round_trip_edge_cases(spark, corpus_fixture):
    from parley.operators.prepare import format_pairs
    pairs = format_pairs(corpus_fixture.na.drop(subset=["instruction", "response"])).withColumn("split", F.lit("train"))
    path = os.path.join(_scratch(), "csv")
    IO.write_pairs_csv(pairs, path)
    back = IO.read_pairs_csv(spark, path)
    assert sorted(map(tuple, back.select(*pairs.columns).collect())) == sorted(map(tuple, pairs.collect()))
    assert IO.scan_csv_dir(spark, path).count() == pairs.count()


def test_scan_split_prunes_partitions(spark):
    path = os.path.join(_scratch(), "splits")
    IO.write_splits(spark.range(30).withColumn("split", F.when(F.col("id") < 10, "test").otherwise("train")), path)
    df = IO.scan_split(spark, path, "test")
    assert df.count() == 10
    assert "PartitionFilters: [isnotnull(split" in df._jdf.queryExecution().executedPlan().toString()


def test_numbered_questions_parse_rules(spark):
    lines = spark.createDataFrame(pd.DataFrame({"value": [
        "1. How do I cancel my order?", "no number here", "no number. but a dot", "", "   7. leading spaces  ",
        "\t2. tab\t"]}))
    got = [r["question"] for r in IO.parse_numbered_questions(lines).collect()]
    assert got == ["How do I cancel my order?", "no number here", "but a dot", "", "leading spaces", "tab"]


def test_numbered_text_round_trip(spark):
    df = spark.createDataFrame([(2, "second q"), (1, "first. q")], "pos int, q string")
    path = os.path.join(_scratch(), "txt")
    IO.write_numbered_text(IO.numbered_lines(df, "q", "pos"), path)
    assert [r["question"] for r in IO.read_numbered_questions(spark, path).collect()] == ["first. q", "second q"]


def test_source_or_default(spark):
    defaults = IO.default_questions(spark)
    empty = spark.createDataFrame([], "pos int, question string")
    got = [r["question"] for r in IO.source_or_default(empty, defaults).orderBy("pos").collect()]
    assert got == DEFAULT_QUESTIONS
    one = spark.createDataFrame([(1, "mine")], "pos int, question string")
    assert [r["question"] for r in IO.source_or_default(one, defaults).collect()] == ["mine"]


def test_result_documents_round_trip(spark):
    log = spark.createDataFrame([("a", i, f"q{i}", f"r{i}", float(i)) for i in range(15)] + [("b", 0, "q", "r", 2.0)],
                                "run string, pos int, query string, response string, response_time double")
    docs = IO.result_documents(log, chunk=10)
    path = os.path.join(_scratch(), "json")
    IO.write_result_documents(docs, path)
    flat = IO.read_response_log(spark, path)
    got = sorted((r["run"], r["pos"], r["query"], r["response_time"]) for r in flat.collect())
    assert got == [("a", i + 1, f"q{i}", float(i)) for i in range(15)] + [("b", 1, "q", 2.0)]
    assert spark.read.json(path).count() == 3  # two documents for run a


def test_published_result_documents(spark):
    one = lambda i: {"query": f"q{i}", "response": f"r{i}", "response_time": i / 2}
    both = lambda i: {"query": f"q{i}", "template_response": "t", "model_response": "m", "template_time": 0.5, "model_time": 1.5}
    folder = _scratch()
    texts = {"validation": {"template_results": [one(i) for i in range(19)], "model_results": [one(i) for i in range(5)], "avg_template_time": 1.0},
             "evaluation": {"template_avg_time": 1.0, "responses": [both(i) for i in range(5)]},
             "inference": {"results": [{"input": "i", "target": "t", "generated": "g", "inference_time": 2.0}], "avg_inference_time": 2.0}}
    rows = {}
    for kind, doc in texts.items():
        with open(os.path.join(folder, f"{kind}.json"), "w") as f:
            json.dump(doc, f, indent=2)
        rows[kind] = IO.read_published_results(spark, os.path.join(folder, f"{kind}.json"), kind).collect()
    assert [len(rows[k]) for k in texts] == [24, 10, 1]
    assert all(r["query"] and r["response"] and r["response_time"] is not None and r["run"] for v in rows.values() for r in v)


# --- streaming ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def chat_folder(spark):
    """Turns split over two files so they arrive in two micro-batches, with a
    clear event in the middle of conversation 1."""
    folder = _scratch()
    a = [(1, 0, "system", ""), (1, 1, "user", "where is my order"), (1, 2, "assistant", "x"),
         (1, 3, "user", ""), (2, 0, "user", "cancel please")]
    b = [(1, 4, "system", ""), (1, 5, "user", "payment failed"), (1, 6, "user", "refund money"),
         (2, 1, "user", "track it")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(a, schema).coalesce(1).write.parquet(os.path.join(folder, "p1"))
    spark.createDataFrame(b, schema).coalesce(1).write.parquet(os.path.join(folder, "p2"))
    for sub in ("p1", "p2"):
        for f in os.listdir(os.path.join(folder, sub)):
            if f.endswith(".parquet"):
                os.rename(os.path.join(folder, sub, f), os.path.join(folder, f"conv-{sub}.parquet"))
    return folder, schema


def test_stream_history_equals_batch_twin(spark, chat_folder):
    folder, schema = chat_folder
    bank = spark.createDataFrame([("track_order", ["T {query}"]), ("general", ["G"])], BANK_SCHEMA)
    stream = S.conversation_stream(spark, folder, glob="conv-*.parquet", files_per_trigger=1)
    positions = S.run_available(S.chat_history(S.answer_stream(stream, bank)), spark, "t-history")
    static = spark.read.parquet(*[os.path.join(folder, f) for f in sorted(os.listdir(folder)) if f.endswith(".parquet")])
    twin = S.chat_history_batch(S.answer_stream(static, bank))
    hist = S.with_texts(positions, S.answer_stream(static, bank))
    key = lambda r: (r["conv_id"], r["turn"])
    a = sorted(hist.collect(), key=key)
    b = sorted(twin.collect(), key=key)
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    pos = {(r["conv_id"], r["turn"]): r["history_pos"] for r in a}
    assert pos == {(1, 1): 1, (1, 5): 1, (1, 6): 2, (2, 0): 1, (2, 1): 2}


def test_answer_stream_replay_identical(spark, chat_folder):
    folder, _ = chat_folder
    bank = spark.createDataFrame([("general", ["G1 {query}", "G2", "G3"])], BANK_SCHEMA)
    outs = []
    for _ in range(2):
        s = S.conversation_stream(spark, folder, glob="conv-*.parquet")
        outs.append(sorted(map(tuple, S.run_available(S.answer_stream(s, bank), spark, "t-ans")
                               .select("conv_id", "turn", "route", "response").collect()),
                           key=lambda t: (t[0], t[1])))
    assert outs[0] == outs[1]


# --- evaluation ----------------------------------------------------------------------------------------


def test_latency_and_speedup_guards(spark):
    log = spark.createDataFrame([("template", 0.0), ("model", 2.0)], "path string, seconds double")
    r = V.latency_summary(log).collect()[0]
    assert r["speedup_factor"] == 0.0
    log2 = spark.createDataFrame([("template", 0.5), ("model", 1.5), ("template", 1.5)], "path string, seconds double")
    assert abs(V.latency_summary(log2).collect()[0]["speedup_factor"] - 1.5) < 1e-12
    runs = spark.createDataFrame([("a", 4.0), ("b", 2.0), ("c", 0.0)], "run string, seconds double")
    assert V.run_speedup(runs, "run", "a", "b").collect()[0]["speedup"] == 2.0
    assert V.run_speedup(runs, "run", "a", "c").collect()[0]["speedup"] == 0.0


def test_accuracy_first_max_wins(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9], 1), ([0.5, 0.2, 0.1], 0), ([0.3, 0.3, 0.1], 1)],
                               "logits array<double>, label int")
    r = V.accuracy(df).collect()[0]
    assert abs(r["accuracy"] - 2 / 3) < 1e-12


def test_response_info_format(spark):
    log = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.123), (2, 1, 3.0)], "k int, t int, seconds double")
    got = {r["k"]: r["info"] for r in V.response_info(log, "k", "t").collect()}
    assert got == {1: "Response time: 0.12 seconds", 2: "Response time: 3.00 seconds"}


# --- classification ----------------------------------------------------------------------------------------


def test_classifier_train_select_evaluate_save(spark):
    from parley.operators import classify as K
    from tests.conftest import SF_CHECK
    from parley.plans.corpus import labelled
    lab = labelled(spark, SF_CHECK)
    sp = K.labelled_splits(lab)
    train = sp.where(F.col("split") == "train")
    valid = sp.where(F.col("split") == "val")
    model = K.train_text_classifier(train)
    ev = K.evaluate_classifier(model, valid).collect()[0]
    assert 0.0 <= ev["accuracy"] <= 1.0 and ev["log_loss"] > 0 and ev["rows"] == valid.count()
    best, table = K.select_best_by_accuracy(train, valid)
    rows = table.collect()
    assert len(rows) == 2 and sum(r["chosen"] for r in rows) == 1
    path = K.save_model(model, os.path.join(_scratch(), "m"))
    a = K.predict(model, valid).select("idx", "prediction").collect()
    b = K.predict(K.load_model(path), valid).select("idx", "prediction").collect()
    assert sorted(a) == sorted(b)
    assert 0 <= K.evaluate_classifier(K.train_text_classifier(train, pipeline=K.logistic_pipeline(maxIter=3)), valid).first()["accuracy"] <= 1
    prep = K.prepare_labelled(lab, n_train=1000, n_valid=200).collect()
    assert all(len(r["input_ids"]) == 128 for r in prep)
    assert {r["split"] for r in prep} == {"train", "val"}


def test_bank_and_config_json(spark):
    from parley.operators import bank as B
    bank = spark.createDataFrame([("general", ["G {query}"])], BANK_SCHEMA)
    path = os.path.join(_scratch(), "bank")
    B.save_bank(bank, path)
    assert B.read_bank(spark, path).collect()[0]["templates"] == ["G {query}"]
    cpath = os.path.join(_scratch(), "cfg")
    IO.write_config(IO.config_document(spark, {"max_input_length": 128, "template_based_generation": True}), cpath)
    cfg = IO.read_config(spark, cpath, multi_line=False).collect()[0]
    assert cfg["max_input_length"] == 128 and cfg["template_based_generation"] is True


class _FakeState:
    def __init__(self, value=None, timed_out=False):
        self.value, self.hasTimedOut, self.removed, self.timeout = value, timed_out, False, None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.removed, self.value = True, None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_history_state_is_one_counter_and_times_out():
    fn = S._history_fn(idle_timeout_ms=1000)
    batch = pd.DataFrame({"turn": [2, 1, 4, 3], "is_clear": [False, False, False, True], "recorded": [True, True, True, False]})
    st = _FakeState()
    out = pd.concat(list(fn((7,), iter([batch[:2], batch[2:]]), st)))
    assert list(out["turn"]) == [1, 2, 4] and list(out["history_pos"]) == [1, 2, 1]
    assert st.value == (1,) and st.timeout == 1000
    more = pd.DataFrame({"turn": [5, 6], "is_clear": [False, False], "recorded": [False, True]})
    assert list(pd.concat(list(fn((7,), iter([more]), st)))["history_pos"]) == [2]
    idle = _FakeState(value=st.value, timed_out=True)
    assert len(pd.concat(list(fn((7,), iter([]), idle)))) == 0 and idle.removed


def test_late_turns_get_turn_order_from_the_written_answers(spark):
    folder, schema = _scratch(), "conv_id bigint, turn bigint, role string, text string"
    for k, rows in enumerate(([(1, 5, "user", "b"), (1, 7, "user", "c"), (None, 1, "user", "n")], [(1, 1, "user", "a"), (1, 6, "system", "")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/conversations.parquet")
    bank = spark.createDataFrame([("general", ["G"])], BANK_SCHEMA)
    stream = S.conversation_stream(spark, folder, files_per_trigger=1)  # a table of several part files
    written = S.run_available(S.answer_stream(stream, bank), spark, "t-late")
    pos = {(r["conv_id"], r["turn"]): r["history_pos"] for r in S.chat_history_batch(written).collect()}
    assert pos == {(1, 1): 1, (1, 5): 2, (1, 7): 1, (None, 1): 1}


def test_vocabulary_equals_plain_top_k(spark):
    words = [f"{c}{i}" for c in "abé" for i in range(40)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(1 + i % 3))
    df = spark.createDataFrame([(1, text), (2, None)], "id long, t string")
    for size in (10, 60, 124, 500):
        got = [(r["token"], r["id"]) for r in E.build_vocabulary(df, ["t"], size).orderBy("id").collect()]
        ranked = sorted(words, key=lambda w: (-text.split().count(w), w.encode()))
        assert got == [(w, i + 4) for i, w in enumerate(ranked[: size - 4])]


def test_csv_empty_strings_and_nulls_survive(spark):
    df = spark.createDataFrame([(1, "", None, "A", "i"), (2, None, "", "B", "j"), (3, "N/A", "null", "", None),
                                (4, " x ", '"q"', "C", "k")],
                               "id bigint, input_text string, target_text string, category string, intent string")
    path = os.path.join(_scratch(), "csv-empty")
    IO.write_pairs_csv(df, path)
    assert sorted(map(tuple, IO.read_pairs_csv(spark, path).collect())) == sorted(map(tuple, df.collect()))


def test_a_large_batch_is_laid_out_in_slices(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    vocab = spark.createDataFrame([("a", 4, 2), ("b", 5, 1)], "token string, id int, n long")
    taken = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run))
    E.encode_columns(df, vocab, [("text", "ids", 512)])
    rows = 8000
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array([["a", "x", "b"] * 100 if k % 2 else ["b"] for k in range(rows)])], names=["id", "_t0"])
    tracemalloc.start()
    seen, peak = 0, 0
    for out in taken[0](iter([batch])):
        for key, ids in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            want = [4, E.UNK_ID, 5] * 100 if key % 2 else [5]
            assert key == seen and ids == [E.BOS_ID, *want, E.EOS_ID] + [E.PAD_ID] * (510 - len(want))
            seen += 1
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == rows and peak < 40_000_000
