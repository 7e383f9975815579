"""Registered query plans: ``name -> (spark, sf_dir) -> DataFrame``.

Every plan reads the driver tables (or data Spark derives from them) in
full.  Columns are named exactly as in the SQL oracles (``plans.oracle``).
Floating results are rounded to 6 decimals and arrays are emitted as text
so that value hashes can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.constants import CLASSIFIER_TRAIN_ROWS, SEED, STOCK_LEXICON
from ..functions.hashing import hash_prefix_int, order_hash
from ..functions.lexicon import PROBE_LEXICON, lexicon_frame
from ..operators import bank as B
from ..operators import classify as K
from ..operators import encode as E
from ..operators import evaluate as V
from ..operators import heavy as H
from ..operators import prepare as P
from ..operators import profile as R
from ..operators import profile_state as PS
from ..operators import respond as A
from ..session import materialize, scratch_path
from ..functions.text import word_tokens
from ..sources import bucketed as BT
from ..sources import csv_split as CS
from ..sources import files as IO
from ..sources.tables import table
from ..streaming import chat as S
from ..streaming import upsert as U
from . import corpus as C
from .flows import evaluate_battery

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), digits))
    return df


# --- projections / filters / distinct ---------------------------------------------------


def q_format_pairs(spark, d):
    return P.format_pairs(C.corpus(spark, d))


def q_drop_missing(spark, d):
    return P.drop_missing(C.corpus(spark, d))


def q_dedup_pairs(spark, d):
    return C.cleaned(spark, d)


def q_dedup_pairs_hash_first(spark, d):
    return C.cleaned(spark, d)


def q_label_vocabulary(spark, d):
    return P.label_vocabulary(C.split(spark, d).where(F.col("split") == "train"))


def q_label_vocabulary_or_default(spark, d):
    prepared = C.split(spark, d).where(F.col("split") == "train")
    return P.label_vocabulary_or_default(prepared, C.corpus(spark, d))


def q_preview(spark, d):
    return P.preview(C.corpus(spark, d)).select("id", "instruction", "category", "intent")


# --- sampling and splitting ------------------------------------------------------------


def q_split(spark, d):
    return C.split(spark, d).select("id", "category", "intent", "split")


def q_split_sizes(spark, d):
    return P.split_sizes(C.split(spark, d))


def q_split_metadata(spark, d):
    s = C.split(spark, d)
    return P.split_metadata(C.corpus(spark, d), s, ["input_text", "target_text", "category", "intent"])


def q_sample_questions(spark, d):
    return P.sample_n(C.cleaned(spark, d), 10, SEED, ["id"], pos_col="pos").select("id", "instruction", "pos")


def q_sample_train_rows(spark, d):
    return P.sample_n(C.train(spark, d), 100, SEED, ["id"]).select("id", "intent")


def q_shuffle_take(spark, d):
    return P.shuffle_take(C.labelled(spark, d), 1000, SEED, ["idx"]).select("idx", "label", "shuffle_pos")


def q_sample_per_group(spark, d):
    return P.sample_per_group(C.train(spark, d), "intent", 5, SEED, ["id"], rank_col="rank").select(
        "intent", "id", "rank")


# --- profile -----------------------------------------------------------------------------


def _profiled(spark, d):
    return R.with_lengths(C.corpus(spark, d))


def q_shape(spark, d):
    return R.shape(_profiled(spark, d))


def q_column_types(spark, d):
    return R.column_types(_profiled(spark, d))


def q_distinct_counts(spark, d):
    return R.distinct_counts(_profiled(spark, d))


def q_distinct_counts_hashed(spark, d):
    return R.distinct_counts(_profiled(spark, d))


def q_top_values(spark, d):
    return R.top_values(_profiled(spark, d))


def q_top_values_hashed(spark, d):
    return R.top_values(_profiled(spark, d))


def q_category_counts(spark, d):
    return R.value_counts(C.corpus(spark, d), "category")


def q_intent_counts(spark, d):
    return R.value_counts(C.corpus(spark, d), "intent")


def q_length_stats(spark, d):
    return _round(R.length_stats(C.corpus(spark, d)),
                  ["mean", "std", "min", "p25", "p50", "p75", "max"])


def q_length_histogram(spark, d):
    return _round(R.length_histogram(C.corpus(spark, d)), ["lo_edge", "hi_edge"])


def q_profile_report(spark, d):
    return R.profile_report(_profiled(spark, d))


def _profile_state(spark, d):
    """The corpus as parts by source and language that come in two deliveries, each scanned once; the second brings some
    parts of the first again.  The profile is read from the states of the parts."""
    path = scratch_path(spark, "profile-state")
    given = _profiled(spark, d)
    part, late = F.concat_ws("/", "intent", "category"), F.pmod(F.crc32("category"), F.lit(2)) == 1
    PS.save_parts(given.where(~late | F.col("category").isNull()), part, path)
    PS.save_parts(given.where(late | (F.col("category") == "EN")), part, path)
    return PS.read_state(spark, path)


def q_profile_state_counts(spark, d):
    """AGG-1 / AGG-3 from states: exact rows and values, and whether the estimate of the distinct ones is within three
    standard errors (half a value more for rounding)."""
    merged = PS.merged_counts(_profile_state(spark, d))
    exact = R.distinct_counts(_profiled(spark, d)).withColumnRenamed("distinct", "exact")
    off = F.abs(F.col("distinct") - F.col("exact"))
    return merged.join(exact, "field").select("field", "rows", "non_null", F.col("exact").alias("distinct"),
                                              (off <= F.col("exact") * (3 * PS.SKETCH_ERROR) + 0.5).alias("estimate_holds"))


def q_profile_state_lengths(spark, d):
    """AGG-6 from states."""
    return _round(R.stats_of_lengths(PS.merged_lengths(_profile_state(spark, d))), ["mean", "std", "min", "p25", "p50", "p75", "max"])


def q_profile_state_histogram(spark, d):
    """AGG-7 from states."""
    return _round(R.bins_of_lengths(PS.merged_lengths(_profile_state(spark, d))), ["lo_edge", "hi_edge"])


def q_top_tokens(spark, d):
    """AGG-4 over the words of all answers: the 1,000 most frequent ones, by summaries of 8,192 counters a task."""
    return H.most_frequent(C.corpus(spark, d), word_tokens("response"), 1000, 8192)


# --- bank and answers ---------------------------------------------------------------------


def q_template_bank(spark, d):
    return B.bank_as_text(C.bank(spark, d))


def q_bank_json_roundtrip(spark, d):
    path = scratch_path(spark, "bank-json")
    B.save_bank(C.bank(spark, d), path)
    return B.bank_as_text(B.read_bank(spark, path))


def q_general_bank(spark, d):
    return B.bank_as_text(B.general_bank(C.train(spark, d)))


def q_classify_intent(spark, d):
    return A.classify_intent(C.questions(spark, d), "query", score_col="score").select(
        "conv_id", "turn", "intent", "score")


def q_classify_intent_probe(spark, d):
    return A.classify_intent(C.questions(spark, d), "query", PROBE_LEXICON, score_col="score").select(
        "conv_id", "turn", "intent", "score")


def q_classify_intent_join(spark, d):
    lex = lexicon_frame(spark, PROBE_LEXICON)
    return A.classify_intent_join(C.questions(spark, d), lex, "query", ["conv_id", "turn"],
                                  score_col="score").select("conv_id", "turn", "intent", "score")


def _word_lexicon(spark, d):
    """A lexicon of every word of four letters or more in the documents, dealt to 50 intents by a hash."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))
    words = table(spark, d, "documents").select(word.alias("keyword")).distinct()
    place = (hash_prefix_int(F.md5("keyword"), 6) % 50).cast("int")
    return words.select(F.concat(F.lit("topic"), place.cast("string")).alias("intent"), (place + 1).alias("priority"), "keyword")


def q_classify_intent_lexicon(spark, d):
    """RSP-4 with a lexicon that grows with the corpus."""
    return A.classify_intent_join(C.questions(spark, d), materialize(_word_lexicon(spark, d), "lexicon"), "query",
                                  ["conv_id", "turn"], score_col="score").select("conv_id", "turn", "intent", "score")


def _answers(spark, d, lexicon, bank=None, use_templates=True):
    b = C.bank(spark, d) if bank is None and use_templates else bank
    return A.answer_questions(C.questions(spark, d), b, lexicon, "query", use_templates).select(
        "conv_id", "turn", "query", "intent", "route", "response", "prompt")


def q_answer_questions(spark, d):
    return _answers(spark, d, STOCK_LEXICON)


def q_answer_questions_probe(spark, d):
    return _answers(spark, d, PROBE_LEXICON)


def q_answer_saved_bank(spark, d):
    """RSP-10 as deployed: the bank is saved once and only read when questions come."""
    path = scratch_path(spark, "saved-bank")
    B.save_bank(C.bank(spark, d), path)
    return _answers(spark, d, PROBE_LEXICON, bank=B.read_bank(spark, path))


def q_answer_default_bank(spark, d):
    return _answers(spark, d, STOCK_LEXICON, bank=B.default_bank(spark))


def q_answer_model_only(spark, d):
    return _answers(spark, d, PROBE_LEXICON, use_templates=False)


def q_generate_batch(spark, d):
    """RSP-9: the recorded model echoes its prompt, so the generator here does too."""
    out = A.generate_batch(_answers(spark, d, PROBE_LEXICON, use_templates=False), lambda prompts: prompts)
    return out.select("conv_id", "turn", "prompt", "generated")


def q_generate_distinct(spark, d):
    """RSP-9 with one call a distinct prompt."""
    out = A.generate_distinct(_answers(spark, d, PROBE_LEXICON, use_templates=False), lambda prompts: prompts)
    return out.select("conv_id", "turn", "prompt", "generated")


def q_map_batches(spark, d):
    """UDF-1: a user function over batches of rows."""
    def measure(pdf):
        return pdf.assign(characters=pdf["query"].str.len())[["conv_id", "turn", "characters"]]

    return A.map_batches(C.questions(spark, d), measure, "conv_id long, turn long, characters long")


def q_load_bank(spark, d):
    """RSP-3: a saved split, a missing one and an unreadable one, by name."""
    good, bad = scratch_path(spark, "bank-train"), scratch_path(spark, "bank-bad")
    C.train(spark, d).write.parquet(good)
    table(spark, d, "region").select(F.lit("no parquet").alias("value")).coalesce(1).write.text(bad)
    parts = [("present", good), ("missing", scratch_path(spark, "bank-none")), ("unreadable", bad)]
    out = None
    for name, path in parts:
        part = B.bank_as_text(B.load_bank(spark, path)).withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def q_side_by_side(spark, d):
    return A.side_by_side(C.questions(spark, d), C.bank(spark, d), PROBE_LEXICON).select(
        "conv_id", "turn", "intent", "template_route", "template_response", "model_prompt")


def q_inference_table(spark, d):
    test = C.split(spark, d).where(F.col("split") == "test")
    return A.inference_table(test, 10, SEED, ["id"])


# --- encoding ------------------------------------------------------------------------------


def _vocab(spark, d):
    return E.build_vocabulary(C.train(spark, d), ["input_text", "target_text"])


def q_build_vocabulary(spark, d):
    return _vocab(spark, d)


def q_build_vocabulary_heavy(spark, d):
    """ENC-1 by summaries first: only tokens that can be kept are counted."""
    return E.build_vocabulary(materialize(C.train(spark, d), "train"), ["input_text", "target_text"], heavy_first=True)


def q_encode_pairs(spark, d):
    train = materialize(C.train(spark, d), "train")
    vocab = materialize(E.build_vocabulary(train, ["input_text", "target_text"]), "vocabulary")
    enc = E.encode_pairs(train, vocab, ["id"])
    return E.arrays_as_text(enc.select("id", "input_ids", "attention_mask", "labels"),
                            ["input_ids", "attention_mask", "labels"])


def q_encode_pairs_lookup(spark, d):
    train = materialize(C.train(spark, d), "train")
    vocab = materialize(E.build_vocabulary(train, ["input_text", "target_text"]), "vocabulary")
    enc = E.encode_pairs(train, vocab, ["id"])
    return E.arrays_as_text(enc.select("id", "input_ids", "attention_mask", "labels"),
                            ["input_ids", "attention_mask", "labels"])


# --- evaluation ------------------------------------------------------------------------------


def _events_log(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", F.col("event_type").alias("path"),
                                            F.col("value").alias("seconds"))


def q_latency_summary(spark, d):
    return _round(V.latency_summary(_events_log(spark, d), template_path="click", model_path="view"),
                  ["avg_template_time", "avg_model_time", "speedup_factor"])


def q_latency_by_path(spark, d):
    return _round(V.latency_by_path(_events_log(spark, d)), ["avg_seconds"])


def q_run_speedup(spark, d):
    return _round(V.run_speedup(_events_log(spark, d), "path", "purchase", "signup"),
                  ["avg_before", "avg_after", "speedup"])


def q_accuracy(spark, d):
    emb = table(spark, d, "embeddings").select(F.col("embedding").alias("logits"), "label")
    return _round(V.accuracy(emb), ["accuracy"])


def q_response_info(spark, d):
    return _round(V.response_info(_events_log(spark, d), "user_id", "event_id"), ["last_seconds"])


# --- sources and sinks (written below the scratch root, read back) -------------------------------


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "pairs-csv")
    IO.write_pairs_csv(C.split(spark, d), path)
    return IO.read_pairs_csv(spark, path)


def q_csv_split_roundtrip(spark, d):
    """SRC-1 by blocks of the files instead of whole files."""
    path = scratch_path(spark, "pairs-csv")
    IO.write_pairs_csv(C.split(spark, d), path)
    return CS.read_csv_records(spark, path, IO.PAIRS_SCHEMA, pathGlobFilter="*.csv", recursiveFileLookup="true").rows


def _csv_field(c):
    return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))


def q_csv_quarantine(spark, d):
    """SRC-1 with damaged records: every seventh line loses its last fields, every eleventh its number."""
    path = scratch_path(spark, "damaged-csv")
    pairs = C.cleaned(spark, d)
    number = F.when(F.col("id") % 11 == 0, F.lit("n/a")).otherwise(F.col("id").cast("string"))
    line = F.concat_ws(",", number, _csv_field("instruction"), _csv_field("response"))
    rest = F.when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.lit(",A,x"))
    pairs.select(F.concat(line, rest).alias("value")).write.text(path)
    found = CS.read_csv_records(spark, path, IO.PAIRS_SCHEMA, header=False)
    return found.damaged.groupBy("reason").agg(F.count(F.lit(1)).alias("records")).unionByName(
        found.rows.agg(F.count(F.lit(1)).alias("records")).withColumn("reason", F.lit("read")))


def q_json_quarantine(spark, d):
    """SRC-5 with damaged documents: every fifth document is cut, every third of the others has a text for a number."""
    path = scratch_path(spark, "damaged-json")
    ev = table(spark, d, "events")
    value = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("event_type").alias("run"), F.col("event_type").alias("seconds")))).otherwise(
        F.to_json(F.struct(F.col("event_type").alias("run"), F.col("value").alias("seconds"))))
    cut = F.when(F.col("event_id") % 5 == 0, F.expr("left(value, 9)")).otherwise(F.col("value"))
    ev.select("event_id", value.alias("value")).select(cut.alias("value")).write.text(path)
    found = CS.read_json_records(spark, path, StructType([StructField("run", StringType()), StructField("seconds", DoubleType())]))
    return found.damaged.groupBy("reason").agg(F.count(F.lit(1)).alias("records")).unionByName(
        found.rows.agg(F.count(F.lit(1)).alias("records")).withColumn("reason", F.lit("read")))


def q_scan_csv_dir(spark, d):
    path = scratch_path(spark, "pairs-csv")
    IO.write_pairs_csv(C.split(spark, d), path)
    return IO.scan_csv_dir(spark, path)


def q_prepared_roundtrip(spark, d):
    path = scratch_path(spark, "prepared")
    sp = materialize(C.split(spark, d), "split")
    vocab = materialize(E.build_vocabulary(sp.where(F.col("split") == "train"), ["input_text", "target_text"]), "vocabulary")
    enc = E.encode_pairs(sp, vocab, ["id"], carry=["split"])
    IO.write_splits(P.select_features(enc, keys=["id", "split"]), path)
    back = None
    for name in ("train", "val", "test"):
        part = IO.scan_split(spark, path, name).select("id", "split", "input_ids", "attention_mask", "labels")
        back = part if back is None else back.unionByName(part)
    return E.arrays_as_text(back, ["input_ids", "attention_mask", "labels"])


def q_prepared_bucketed(spark, d):
    """SNK-2 / SRC-6 as two bucketed tables, pairs and their ids, joined by key where they lie."""
    pairs = BT.write_bucketed(C.split(spark, d), scratch_path(spark, "pairs-bucketed"), ["id"])
    vocab = materialize(E.build_vocabulary(pairs.where(F.col("split") == "train"), ["input_text", "target_text"]), "vocabulary")
    path = scratch_path(spark, "ids-bucketed")
    BT.write_bucketed(P.select_features(E.encode_pairs(pairs, vocab, ["id"]), keys=["id"]), path, ["id"])
    both = pairs.select("id", "split").join(BT.open_bucketed(spark, path), "id")
    return E.arrays_as_text(both.select("id", "split", "input_ids", "attention_mask", "labels"), ["input_ids", "attention_mask", "labels"])


def q_dedup_against_index(spark, d):
    """DST-1 against what was seen: the corpus without the pairs of the saved training split."""
    sp = materialize(C.split(spark, d), "split").withColumnsRenamed({"input_text": "instruction", "target_text": "response"})
    path = scratch_path(spark, "seen")
    BT.save_seen(sp.where(F.col("split") == "train"), path)
    return BT.drop_seen(P.drop_missing(C.corpus(spark, d)), BT.open_bucketed(spark, path))


def q_numbered_questions(spark, d):
    path = scratch_path(spark, "questions-txt")
    numbered = C.cleaned(spark, d).select(F.col("id").alias("pos"), "instruction")
    IO.write_numbered_text(IO.numbered_lines(numbered, "instruction", "pos"), path)
    return IO.read_numbered_questions(spark, path).select("value", "question")


def q_numbered_sample(spark, d):
    """SNK-4 / SRC-4: lines numbered from 1, written and read back."""
    path = scratch_path(spark, "sample-txt")
    sample = P.sample_n(C.cleaned(spark, d), 10, SEED, ["id"], pos_col="pos")
    IO.write_numbered_text(IO.numbered_lines(sample, "instruction", "pos"), path)
    return IO.read_numbered_questions(spark, path).select("value", "question")


def q_source_or_default_empty(spark, d):
    none = C.cleaned(spark, d).where(F.length("instruction") < 0).select(
        F.col("id").cast("int").alias("pos"), F.col("instruction").alias("question"))
    return IO.source_or_default(none, IO.default_questions(spark))


def q_source_or_default(spark, d):
    sample = P.sample_n(C.cleaned(spark, d), 10, SEED, ["id"], pos_col="pos").select(
        "pos", F.col("instruction").alias("question"))
    return IO.source_or_default(sample, IO.default_questions(spark))


def _response_log(spark, d):
    ev = table(spark, d, "events")
    return ev.select(F.col("event_type").alias("run"),
                     F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("query"),
                     F.col("props").alias("response"), F.col("value").alias("response_time"),
                     order_hash(SEED, ["event_id"]).alias("_h"), "event_id")


def q_response_log_roundtrip(spark, d):
    path = scratch_path(spark, "results-json")
    IO.write_result_documents(IO.result_documents(_response_log(spark, d), "run", order_col="_h"), path)
    flat = IO.read_response_log(spark, path)
    sums = flat.groupBy("run").agg(F.sum("response_time").alias("_s"), F.count(F.lit(1)).cast("bigint").alias("responses_total"))
    sums = sums.select("run", (F.col("_s") / F.col("responses_total")).alias("avg_response_time"), "responses_total")
    return _round(flat.join(sums, "run").drop("source_file"), ["avg_response_time", "response_time"])


def _published(spark, log, kind):
    path = scratch_path(spark, f"{kind}-json")
    IO.write_result_documents(IO.published_documents(log, kind, "_h", 500), path)
    flat = IO.read_published_results(spark, path, kind, multi_line=False)
    return _round(flat.select("run", "query", "response", "response_time"), ["response_time"])


def q_published_validation(spark, d):
    """SNK-6 / SRC-5 in the shape of the validation results."""
    run = F.when(F.col("run") == "click", "template").when(F.col("run") == "view", "model")
    return _published(spark, _response_log(spark, d).withColumn("run", run), "validation")


def q_published_evaluation(spark, d):
    """SNK-6 / SRC-5 in the shape of the evaluation: both paths of a query in one entry."""
    log = _response_log(spark, d).select("_h", "query", F.col("response").alias("template_response"), F.upper("response").alias("model_response"),
                                         F.col("response_time").alias("template_time"), (F.col("response_time") * 2).alias("model_time"))
    return _published(spark, log, "evaluation")


def q_published_inference(spark, d):
    """SNK-6 / SRC-5 in the shape of the generated texts."""
    log = _response_log(spark, d).select("_h", F.col("query").alias("input"), F.col("run").alias("target"), F.col("response").alias("generated"),
                                         F.col("response_time").alias("inference_time"))
    return _published(spark, log, "inference")


def q_metadata_json(spark, d):
    path = scratch_path(spark, "metadata-json")
    meta = q_split_metadata(spark, d)
    IO.write_json_rows(meta, path)
    return spark.read.schema(meta.schema).json(path)


def q_profile_report_text(spark, d):
    path = scratch_path(spark, "profile-txt")
    IO.write_report(R.profile_report(_profiled(spark, d)), path)
    return spark.read.text(path)


def q_validation_battery(spark, d):
    out = evaluate_battery(C.questions(spark, d), C.bank(spark, d), 19, PROBE_LEXICON, ("conv_id", "turn"))
    return out.select("pos", "query", "intent", "template_route", "template_response", "model_prompt")


# --- streaming ---------------------------------------------------------------------------------------


def q_answer_stream(spark, d):
    turns = S.conversation_stream(spark, d)
    ans = S.answer_stream(turns, C.bank(spark, d), PROBE_LEXICON)
    out = S.run_available(ans.where(F.col("role") == "user"), spark, "answers")
    return out.select("conv_id", "turn", F.col("text").alias("query"), "intent", "route", "response", "prompt")


def _deliveries(spark, d):
    """A folder of turns with the time they were sent, in four parts a day apart: one part arrives a day
    late, and all arrive once more."""
    folder = scratch_path(spark, "turn-files")
    part = F.pmod("conv_id", F.lit(4))
    sent = F.timestamp_seconds(F.lit(1_700_000_000) + part * 86_400 + F.pmod("turn", F.lit(3600)))
    turns = table(spark, d, "conversations").withColumn("sent_at", sent)
    for k in (0, 2, 1, 3, 0, 1, 2, 3):
        turns.where(part == k).write.mode("append").parquet(folder)
    return folder, turns.schema


def q_answer_stream_once(spark, d):
    """STR-1 with messages that arrive late and twice."""
    folder, schema = _deliveries(spark, d)
    turns = S.once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(folder), delay="36 hours")
    ans = S.answer_stream(turns, materialize(C.bank(spark, d), "bank"), PROBE_LEXICON)
    out = S.run_available(ans.where(F.col("role") == "user"), spark, "answers-once")
    return out.select("conv_id", "turn", F.col("text").alias("query"), "intent", "route", "response", "prompt")


def _events(turns):
    """Chat events derived from the given turns: every fifth turn clears the
    history and some user messages (by a hash) are empty."""
    h = F.substring(order_hash(SEED, ["conv_id", "turn"]), 1, 1)
    clear = (F.col("turn") % 5) == 4
    return turns.select(
        "conv_id", "turn", F.when(clear, "system").otherwise(F.col("role")).alias("role"),
        F.when(~clear & h.isin("0", "1", "2"), "").otherwise(F.col("text")).alias("text"))


def q_chat_history_stream(spark, d):
    bank = materialize(C.bank(spark, d), "bank")
    live = S.answer_stream(S.conversation_stream(spark, d), bank, PROBE_LEXICON)
    positions = S.run_available(S.chat_history(live), spark, "history")
    return S.with_texts(positions, S.answer_stream(table(spark, d, "conversations"), bank, PROBE_LEXICON))


def q_chat_history(spark, d):
    turns = table(spark, d, "conversations")
    return S.chat_history_batch(S.answer_stream(turns, C.bank(spark, d), PROBE_LEXICON), flags=S.message_flags(turns))


def q_chat_history_bucketed(spark, d):
    """STR-2 / STR-3 over recorded answers that lie bucketed by conversation and turn."""
    turns = table(spark, d, "conversations")
    answered = S.answer_stream(turns, C.bank(spark, d), PROBE_LEXICON).where(F.col("recorded")).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "message", "response")
    saved = BT.write_bucketed(answered, scratch_path(spark, "answered-bucketed"), ["conv_id", "turn"])
    return S.with_saved_texts(S.history_positions(S.message_flags(turns)), saved)


def q_chat_history_events(spark, d):
    turns = _events(table(spark, d, "conversations"))
    return S.chat_history_batch(S.answer_stream(turns, C.bank(spark, d), PROBE_LEXICON), flags=S.message_flags(turns))


def q_chat_history_events_stream(spark, d):
    """Answers are streamed; positions come from the written turns, whatever their order of arrival."""
    live = S.answer_stream(_events(S.conversation_stream(spark, d)), materialize(C.bank(spark, d), "bank"), PROBE_LEXICON)
    return S.chat_history_batch(S.run_available(live, spark, "answered"))


def q_guarded_answers(spark, d):
    turns = _events(table(spark, d, "conversations")).where(F.col("role") == "user").withColumnRenamed("text", "query")
    return A.answer_questions(turns, C.bank(spark, d), PROBE_LEXICON).select(
        "conv_id", "turn", "query", "intent", "route", "response", "prompt")


# --- classification -----------------------------------------------------------------------------------


def q_prepare_labelled(spark, d):
    out = K.prepare_labelled(C.labelled(spark, d))
    return E.arrays_as_text(out, ["input_ids", "attention_mask"])


def _cls_parts(spark, d):
    sp = K.labelled_splits(C.labelled(spark, d))
    train = P.shuffle_take(sp.where(F.col("split") == "train"), CLASSIFIER_TRAIN_ROWS, SEED, ["idx"])
    return train, sp.where(F.col("split") == "val")


def q_train_text_classifier(spark, d):
    train, valid = _cls_parts(spark, d)
    return K.predict(K.train_text_classifier(train), valid).select("idx", "label", "prediction")


def q_select_best_by_accuracy(spark, d):
    train, valid = _cls_parts(spark, d)
    return _round(K.select_best_by_accuracy(train, valid)[1], ["smoothing", "accuracy"])


def q_evaluate_classifier(spark, d):
    train, valid = _cls_parts(spark, d)
    return _round(K.evaluate_classifier(K.train_text_classifier(train), valid), ["accuracy", "log_loss"])


def q_save_model(spark, d):
    train, valid = _cls_parts(spark, d)
    path = K.save_model(K.train_text_classifier(train), scratch_path(spark, "model"))
    return K.predict(K.load_model(path), valid).select("idx", "label", "prediction")


def q_train_or_sample(spark, d):
    train = C.train(spark, d)
    sample = P.sample_n(train, 100, SEED, ["id"])
    return P.train_or_sample(train, sample, use_sample=True).select("id", "intent")


def q_train_without_sample(spark, d):
    """FLT-3 with the switch off: all training rows."""
    train = materialize(C.train(spark, d), "train")
    return P.train_or_sample(train, P.sample_n(train, 100, SEED, ["id"]), use_sample=False).select("id", "intent")


def q_metric_callback(spark, d):
    emb = table(spark, d, "embeddings").select(F.col("embedding").alias("logits"), "label")
    pred = V.predictions(emb)
    err = V.metric_callback(pred, lambda p, l: F.avg((p != l).cast("double")), name="error_rate")
    return _round(err, ["error_rate"])


def q_batch_metric(spark, d):
    emb = table(spark, d, "embeddings").select(F.col("embedding").alias("logits"), "label")
    sums = V.batch_metric(V.predictions(emb), lambda p, r: {"hits": (p == r).sum(), "rows": len(p)}, ["hits", "rows"])
    return sums.select(F.col("hits").cast("bigint").alias("hits"), F.col("rows").cast("bigint").alias("rows"))


def q_response_info_stream(spark, d):
    ev = S.file_stream(spark, d, "events.parquet").select(
        "event_id", "user_id", F.col("value").alias("seconds"))
    return _round(_upserted_info(spark, ev), ["last_seconds"])


def _upserted_info(spark, ev):
    info = S.response_info_stream(ev, "user_id", "event_id", "seconds")
    path = scratch_path(spark, "info-table")
    U.upsert_available(info, spark, path, ["user_id"])
    return U.latest(spark, path, info.schema, ["user_id"])


def q_response_info_upsert(spark, d):
    """STR-4 over several micro-batches: the events arrive as files, the latest first."""
    folder = scratch_path(spark, "event-files")
    ev = table(spark, d, "events").select("event_id", "user_id", F.col("value").alias("seconds"))
    for late in (False, True):
        part = ev.where((F.col("event_id") % 3 == 0) == F.lit(late))
        part.write.mode("append").parquet(folder)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    return _round(_upserted_info(spark, stream), ["last_seconds"])


QUERIES: dict[str, Query] = {
    "format_pairs": q_format_pairs,
    "drop_missing": q_drop_missing,
    "dedup_pairs": q_dedup_pairs,
    "dedup_pairs_hash_first": q_dedup_pairs_hash_first,
    "label_vocabulary": q_label_vocabulary,
    "label_vocabulary_or_default": q_label_vocabulary_or_default,
    "preview": q_preview,
    "split_train_val_test": q_split,
    "split_sizes": q_split_sizes,
    "split_metadata": q_split_metadata,
    "sample_questions": q_sample_questions,
    "sample_train_rows": q_sample_train_rows,
    "shuffle_take": q_shuffle_take,
    "sample_per_group": q_sample_per_group,
    "shape": q_shape,
    "column_types": q_column_types,
    "distinct_counts": q_distinct_counts,
    "distinct_counts_hashed": q_distinct_counts_hashed,
    "top_values": q_top_values,
    "top_values_hashed": q_top_values_hashed,
    "category_counts": q_category_counts,
    "intent_counts": q_intent_counts,
    "length_stats": q_length_stats,
    "length_histogram": q_length_histogram,
    "profile_report": q_profile_report,
    "profile_state_counts": q_profile_state_counts,
    "profile_state_lengths": q_profile_state_lengths,
    "profile_state_histogram": q_profile_state_histogram,
    "top_tokens": q_top_tokens,
    "template_bank": q_template_bank,
    "general_bank": q_general_bank,
    "bank_json_roundtrip": q_bank_json_roundtrip,
    "classify_intent": q_classify_intent,
    "classify_intent_probe": q_classify_intent_probe,
    "classify_intent_join": q_classify_intent_join,
    "classify_intent_lexicon": q_classify_intent_lexicon,
    "answer_questions": q_answer_questions,
    "answer_questions_probe": q_answer_questions_probe,
    "answer_saved_bank": q_answer_saved_bank,
    "answer_default_bank": q_answer_default_bank,
    "answer_model_only": q_answer_model_only,
    "generate_batch": q_generate_batch,
    "generate_distinct": q_generate_distinct,
    "map_batches": q_map_batches,
    "load_bank": q_load_bank,
    "side_by_side": q_side_by_side,
    "inference_table": q_inference_table,
    "build_vocabulary": q_build_vocabulary,
    "build_vocabulary_heavy": q_build_vocabulary_heavy,
    "encode_pairs": q_encode_pairs,
    "encode_pairs_lookup": q_encode_pairs_lookup,
    "latency_summary": q_latency_summary,
    "latency_by_path": q_latency_by_path,
    "run_speedup": q_run_speedup,
    "accuracy": q_accuracy,
    "response_info": q_response_info,
    "csv_roundtrip": q_csv_roundtrip,
    "scan_csv_dir": q_scan_csv_dir,
    "csv_split_roundtrip": q_csv_split_roundtrip,
    "csv_quarantine": q_csv_quarantine,
    "json_quarantine": q_json_quarantine,
    "prepared_roundtrip": q_prepared_roundtrip,
    "prepared_bucketed": q_prepared_bucketed,
    "dedup_against_index": q_dedup_against_index,
    "numbered_questions": q_numbered_questions,
    "numbered_sample": q_numbered_sample,
    "source_or_default": q_source_or_default,
    "source_or_default_empty": q_source_or_default_empty,
    "response_log_roundtrip": q_response_log_roundtrip,
    "published_validation": q_published_validation,
    "published_evaluation": q_published_evaluation,
    "published_inference": q_published_inference,
    "metadata_json": q_metadata_json,
    "profile_report_text": q_profile_report_text,
    "validation_battery": q_validation_battery,
    "answer_stream": q_answer_stream,
    "answer_stream_once": q_answer_stream_once,
    "chat_history_stream": q_chat_history_stream,
    "chat_history": q_chat_history,
    "chat_history_bucketed": q_chat_history_bucketed,
    "chat_history_events": q_chat_history_events,
    "chat_history_events_stream": q_chat_history_events_stream,
    "guarded_answers": q_guarded_answers,
    "prepare_labelled": q_prepare_labelled,
    "train_text_classifier": q_train_text_classifier,
    "select_best_by_accuracy": q_select_best_by_accuracy,
    "evaluate_classifier": q_evaluate_classifier,
    "save_model": q_save_model,
    "train_or_sample": q_train_or_sample,
    "train_without_sample": q_train_without_sample,
    "metric_callback": q_metric_callback,
    "batch_metric": q_batch_metric,
    "response_info_stream": q_response_info_stream,
    "response_info_upsert": q_response_info_upsert,
}
