"""Profiles from states of parts, summaries of frequent tokens, and bucketed tables, against full scans."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.functions.text import word_tokens
from parley.operators import heavy as H
from parley.operators import profile as R
from parley.operators import profile_state as PS
from parley.session import materialize, scratch_path
from parley.sources import bucketed as BT
from parley.streaming import chat as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


# --- profile state ------------------------------------------------------------------------


def test_merged_state_equals_a_full_scan(spark, corpus_fixture):
    path = scratch_path(spark, "state")
    whole = R.with_lengths(corpus_fixture)
    parts = {"2024/01": whole.where("id < 4"), "a=b c": whole.where("id >= 4 and id < 9"), "rest": whole.where("id >= 9"),
             "none": whole.limit(0)}
    assert PS.update(spark, path, dict(list(parts.items())[:2])) == ["2024/01", "a=b c"]
    assert PS.update(spark, path, parts) == ["rest", "none"]
    assert PS.update(spark, path, parts) == []
    state = PS.read_state(spark, path)
    assert rows_of(R.stats_of_lengths(PS.merged_lengths(state))) == rows_of(R.length_stats(whole))
    assert rows_of(R.bins_of_lengths(PS.merged_lengths(state))) == rows_of(R.length_histogram(whole))
    assert PS.merged_shape(state).first().asDict() == R.shape(whole).first().asDict()
    got = {r["field"]: r for r in PS.merged_counts(state).collect()}
    for r in R.column_types(whole).collect():
        assert got[r["field"]]["non_null"] == r["non_null"]
    assert {f: r["distinct"] for f, r in got.items()} == {r["field"]: r["distinct"] for r in R.distinct_counts(whole).collect()}


def test_a_changed_part_overwrites_its_state(spark, corpus_fixture):
    path = scratch_path(spark, "state")
    PS.save_part(corpus_fixture, "p", path)
    PS.save_part(corpus_fixture.where("id < 4"), "p", path)
    PS.save_part(corpus_fixture.where("id >= 4").withColumn("extra", F.lit(1)), "q", path)
    state = PS.read_state(spark, path)
    assert PS.merged_shape(state).first().asDict() == {"rows": 10, "columns": 7}
    assert PS.merged_shape(PS.read_state(spark, path, ["p"])).first().asDict() == {"rows": 3, "columns": 6}
    assert {r["field"]: r["rows"] for r in PS.merged_counts(state).collect()}["extra"] == 7


def test_one_scan_of_many_parts(spark, corpus_fixture):
    path = scratch_path(spark, "state")
    whole = R.with_lengths(corpus_fixture)
    PS.save_parts(whole.where("id < 9"), F.concat_ws("/", "category", "intent"), path)  # a null intent, too
    PS.save_parts(whole.where("category = 'ACCOUNT'"), F.concat_ws("/", "category", "intent"), path)  # one known, one new
    state = PS.read_state(spark, path)
    want = whole.where("id < 9 or category = 'ACCOUNT'")
    assert rows_of(R.stats_of_lengths(PS.merged_lengths(state))) == rows_of(R.length_stats(want))
    assert PS.merged_shape(state).first().asDict() == R.shape(want).first().asDict()
    assert PS.merged_shape(PS.read_state(spark, path, ["ORDER/cancel_order"])).first()["rows"] == 3
    got = {r["field"]: r["distinct"] for r in PS.merged_counts(state).collect()}
    assert got == {r["field"]: r["distinct"] for r in R.distinct_counts(want).collect()}


def test_no_state_yet(spark):
    state = PS.read_state(spark, scratch_path(spark, "state"))
    assert PS.merged_shape(state).first().asDict() == {"rows": 0, "columns": 0}
    assert PS.merged_lengths(state).count() == 0


def test_estimates_of_many_overlapping_parts(spark):
    path = scratch_path(spark, "state")
    for k in range(4):  # every value is in two parts
        df = spark.range(k * 20000, k * 20000 + 40000).select((F.col("id") % 80000).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
        PS.save_part(df, str(k), path, ["a", "b"])
    got = {r["field"]: r for r in PS.merged_counts(PS.read_state(spark, path)).collect()}
    assert got["a"]["rows"] == 160000 and abs(got["a"]["distinct"] - 80000) <= 80000 * 3 * PS.SKETCH_ERROR
    assert got["b"]["non_null"] == 0 and got["b"]["distinct"] == 0


# --- frequent tokens -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(5)
    ranks = np.minimum(np.random.default_rng(5).zipf(1.3, 60000), 30000)
    texts = [" ".join(f"w{r}" for r in ranks[i:i + 30]) for i in range(0, len(ranks), 30)]
    texts += [None, "", " ", "hot " * 20000, "Once"] + [f"tie{rng.randrange(50)}" for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    return materialize(df, "words"), Counter(w for t in texts if t for w in t.lower().split())


def test_bounds_and_loss_hold(spark, words):
    df, true = words
    out = H.summaries(df, word_tokens("text"), 64).collect()
    lost = sum(r["n"] for r in out if r["token"] is None)
    low = Counter()
    for r in out:
        if r["token"] is not None:
            low[r["token"]] += r["n"]
    assert lost > 0 and len(out) <= 65 * df.rdd.getNumPartitions()
    assert all(low[w] <= n <= low[w] + lost for w, n in true.items())


@pytest.mark.parametrize("k, counters", [(1, 64), (10, 64), (50, 512), (200, 64), (1000, 1 << 18), (10 ** 6, 64)])
def test_most_frequent_equal_counted_ones(spark, words, k, counters):
    df, true = words
    want = sorted(true.items(), key=lambda x: (-x[1], x[0]))[:k]
    assert [(r["token"], r["n"]) for r in H.most_frequent(df, word_tokens("text"), k, counters).collect()] == want


def test_most_frequent_of_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert H.most_frequent(none, word_tokens("text"), 5).collect() == []


def test_only_summaries_are_shuffled(spark, words):
    df, true = words
    plan = plan_of(H.summaries(df, word_tokens("text"), 64).groupBy("token").agg(F.sum("n")))
    assert "MapInArrow" in plan and plan.index("Exchange") < plan.index("MapInArrow")  # nothing is exchanged below


# --- bucketed tables -------------------------------------------------------------------------


@pytest.fixture()
def exchanging(spark):
    """No side is broadcast, so that only buckets can save an exchange."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_tables_join_without_exchange(spark, exchanging):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    BT.write_bucketed(spark.range(1000).withColumn("x", F.col("id") * 2), a, ["id"], 16)
    BT.write_bucketed(spark.range(500, 1500).withColumn("y", F.array(F.col("id").cast("int"))), b, ["id"], 16)
    joined = BT.open_bucketed(spark, a).join(BT.open_bucketed(spark, b), "id")
    assert "Exchange" not in plan_of(joined)
    assert joined.where("x = 2 * y[0]").count() == 500


def test_appended_rows_keep_the_layout(spark, exchanging):
    path = scratch_path(spark, "t")
    BT.write_bucketed(spark.range(10).withColumn("x", F.lit("a")), path, ["id"], 4)
    t = BT.write_bucketed(spark.range(5, 20).select(F.lit("b").alias("x"), "id"), path, ["id"], mode="append")
    grouped = t.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in plan_of(grouped)
    assert {r["id"]: r["n"] for r in grouped.collect()} == {i: 2 if 5 <= i < 10 else 1 for i in range(20)}


SUBSET = "id bigint, instruction string, response string"


def test_pairs_seen_before_are_dropped(spark, exchanging):
    old = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, None, "x"), (4, "", "y")], SUBSET)
    new = spark.createDataFrame([(1, "a", "b"), (2, "ab", ""), (3, "", "ab"), (4, None, "x"), (5, "", "x"), (6, None, "y"),
                                 (7, "", "y"), (None, "n", "n"), (None, "n", "n")], SUBSET)
    path = scratch_path(spark, "seen")
    BT.save_seen(old, path, buckets=4)
    kept = BT.drop_seen(new, BT.open_bucketed(spark, path))
    assert kept.columns == new.columns
    assert sorted(map(str, (r["id"] for r in kept.collect()))) == sorted(map(str, [2, 3, 5, 6, None, None]))
    BT.save_seen(new, path, mode="append")
    assert BT.drop_seen(new.union(old), BT.open_bucketed(spark, path)).count() == 0
    assert BT.drop_seen(new.limit(0), BT.open_bucketed(spark, path)).count() == 0


def test_the_index_is_not_exchanged(spark, exchanging):
    path = scratch_path(spark, "seen")
    index = BT.save_seen(spark.range(2000).selectExpr("cast(id as string) instruction", "'r' response"), path, buckets=16)
    new = spark.range(1900, 2100).selectExpr("cast(id as string) instruction", "'r' response")
    met = new.select(BT.digest(["instruction", "response"]).alias("digest")).distinct().join(index, "digest", "left_semi")
    join, *below = plan_of(met).split("SortMergeJoin", 1)[1].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in below]
    scan = next(i for i, line in enumerate(below) if "Bucketed: true" in line)
    over = [below[i] for i in range(scan) if all(depth[i] < depth[k] for k in range(i + 1, scan + 1))]  # from the join to the scan
    assert over and not any("Exchange" in line for line in over)
    assert BT.drop_seen(new, index).count() == 100


def test_history_reads_recorded_turns_where_they_lie(spark, exchanging):
    rows = [(c, t, t % 3 != 2, t % 5 == 4, f"m{c}-{t}", f"r{c}-{t}") for c in (1, 2, None) for t in range(12)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, recorded boolean, is_clear boolean, message string, response string")
    saved = BT.write_bucketed(turns.where("recorded").select("conv_id", "turn", "message", "response"), scratch_path(spark, "turns"),
                              ["conv_id", "turn"], 8)
    got = S.with_saved_texts(S.history_positions(turns), saved)
    assert rows_of(got) == rows_of(S.chat_history_batch(turns))
