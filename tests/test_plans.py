"""Plan-shape checks on registered queries (small data, final AQE plans)."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.test_prepare import single_partition_outside_broadcast


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_classification_is_one_narrow_stage(spark):
    plan = final_plan(entry.queries()["classify_intent_probe"](spark, SF_SMALL))
    assert "Exchange" not in plan and "Python" not in plan


def test_no_single_partition_over_data(spark):
    for name in ("dedup_pairs", "dedup_pairs_hash_first", "split_train_val_test", "chat_history",
                 "answer_questions_probe", "encode_pairs", "length_stats"):
        plan = final_plan(entry.queries()[name](spark, SF_SMALL))
        assert single_partition_outside_broadcast(plan) == [], name


def test_scans_read_only_needed_columns(spark):
    plan = final_plan(entry.queries()["split_sizes"](spark, SF_SMALL))
    assert "ReadSchema: struct<id:bigint>" in plan  # of the written pairs, no text is read
    counts = final_plan(entry.queries()["length_stats"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in counts
    q = final_plan(entry.queries()["classify_intent_probe"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in q


def test_python_only_where_designed(spark):
    for name in ("answer_questions_probe", "chat_history", "split_train_val_test"):
        assert "Python" not in final_plan(entry.queries()[name](spark, SF_SMALL)), name


def test_encoding_a_written_split_moves_no_rows(spark, tmp_path):
    from parley.operators import encode as E
    from parley.plans import corpus as C

    C.train(spark, SF_SMALL).write.parquet(f"{tmp_path}/train")
    train = spark.read.parquet(f"{tmp_path}/train")
    vocab = E.build_vocabulary(train, ["input_text", "target_text"])
    plan = final_plan(E.encode_pairs(train, vocab, ["id"]))
    assert "MapInArrow" in plan and "Exchange" not in plan and "Sort" not in plan


def test_lexicon_table_needs_no_nested_loop(spark):
    plan = final_plan(entry.queries()["classify_intent_join"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
