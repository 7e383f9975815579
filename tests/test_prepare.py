"""Cleaning, de-duplication, sampling and the exact-size split."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parley.functions import bloom
from parley.functions.hashing import order_hash
from parley.functions.ranking import rank_cuts, running_count
from parley.operators import prepare as P
from parley.session import materialize, scratch_path
from parley.streaming.chat import run_available


def test_drop_missing_and_dedup_keep_first(corpus_fixture):
    clean = P.dedup_pairs(P.drop_missing(corpus_fixture))
    ids = sorted(r["id"] for r in clean.collect())
    # 4/5 have nulls; 2 duplicates 1 (kept: lowest id); 9 duplicates 8
    assert ids == [1, 3, 6, 7, 8, 10]
    first = {r["id"]: r for r in clean.collect()}
    assert first[1]["flags"] == "GENERAL" and first[8]["intent"] == "delivery"
    # N/A stays a value: no CSV re-read in between
    assert first[7]["instruction"] == "N/A"
    again = P.dedup_pairs(clean)
    assert sorted(r["id"] for r in again.collect()) == ids


def test_dedup_is_exact_case_and_space(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "A", "b"), (3, "a ", "b"), (4, "a", "b")],
                               "id bigint, instruction string, response string")
    assert sorted(r["id"] for r in P.dedup_pairs(df).collect()) == [1, 2, 3]


def test_dedup_plan_limits_before_shuffle(corpus_fixture):
    plan = P.dedup_pairs(corpus_fixture)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_format_pairs_drops_flags(corpus_fixture):
    cols = P.format_pairs(corpus_fixture).columns
    assert cols == ["id", "input_text", "target_text", "category", "intent"]
    assert P.format_pairs(corpus_fixture.drop("intent", "category")).columns == ["id", "input_text", "target_text"]


def test_label_vocabulary_first_appearance_keeps_null(corpus_fixture):
    rows = P.label_vocabulary(corpus_fixture).collect()
    intents = [r["value"] for r in sorted((r for r in rows if r["field"] == "intent"), key=lambda r: r["position"])]
    assert intents == ["cancel_order", "track_order", "account", "contact_customer_service", None, "delivery"]
    assert P.label_vocabulary(corpus_fixture.drop("intent")).count() == 0


def test_sample_n_exact_and_seeded(spark):
    df = spark.range(1000)
    s1 = [r["id"] for r in P.sample_n(df, 10, 42, ["id"], "pos").orderBy("pos").collect()]
    s2 = [r["id"] for r in P.sample_n(df.repartition(7), 10, 42, ["id"], "pos").orderBy("pos").collect()]
    assert s1 == s2 and len(set(s1)) == 10
    assert P.sample_n(df, 5000, 42, ["id"]).count() == 1000
    assert [r["id"] for r in P.sample_n(df, 10, 7, ["id"], "pos").orderBy("pos").collect()] != s1
    plan = P.sample_n(df, 10, 42, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_sample_per_group_bounds_and_skew(spark):
    # one hot group holds most rows
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        (F.col("id") % 7).cast("string")).alias("g"))
    df = df.unionByName(spark.createDataFrame([(99999, None)], "id bigint, g string"))
    out = P.sample_per_group(df, "g", 5, 42, ["id"])
    counts = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert None not in counts and all(c == 5 for c in counts.values())
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_split_counts_golden():
    assert P.split_counts(26872) == (21496, 2688, 2688)
    assert P.split_counts(1000) == (800, 100, 100)
    assert P.split_counts(7) == (5, 1, 1)


def _global_rank_split(df, seed=42):
    n = df.count()
    _, n_val, n_test = P.split_counts(n)
    w = Window.orderBy("_h", "id")
    r = df.withColumn("_h", order_hash(seed, ["id"])).withColumn("_r", F.row_number().over(w))
    return {row["id"]: ("test" if row["_r"] <= n_test else "val" if row["_r"] <= n_test + n_val else "train")
            for row in r.collect()}


def test_split_exact_disjoint_covering_and_equal_to_global_rank(spark):
    for n, digits in [(1, 1), (10, 1), (997, 2), (5000, 4), (2000, 1)]:
        df = spark.range(n).repartition(5)
        sp = P.split_train_val_test(df, ["id"], hex_digits=digits)
        got = {r["id"]: r["split"] for r in sp.collect()}
        assert len(got) == n and sp.count() == n
        train, val, test = P.split_counts(n)
        vals = list(got.values())
        assert (vals.count("train"), vals.count("val"), vals.count("test")) == (train, val, test)
        assert got == _global_rank_split(df)


def single_partition_outside_broadcast(plan: str) -> list[str]:
    """Lines of ``Exchange SinglePartition`` not nested under a BroadcastExchange."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        under_broadcast = False
        for prev in reversed(lines[:i]):
            d = len(prev) - len(prev.lstrip(" :+-"))
            if d < depth:
                depth = d
                if "BroadcastExchange" in prev:
                    under_broadcast = True
                    break
        if not under_broadcast:
            bad.append(line.strip())
    return bad


def test_split_plan_has_no_single_partition_over_data(spark):
    sp = P.split_train_val_test(spark.range(100).repartition(4), ["id"])
    sp.collect()
    plan = sp._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" in plan  # the bucket-count table ...
    assert single_partition_outside_broadcast(plan) == []  # ... and only under a broadcast
    naive = spark.range(100).withColumn("r", F.row_number().over(Window.orderBy("id")))
    naive.collect()
    assert single_partition_outside_broadcast(naive._jdf.queryExecution().executedPlan().toString())


def test_running_count_matches_window_on_hot_key(spark):
    df = spark.range(500).select(
        F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id") % 5 + 2).alias("k"),
        F.col("id").alias("t"), ((F.col("id") * 7) % 3 == 0).alias("f"))
    got = running_count(df, ["k"], "t", F.col("f"), "rc", chunk=16)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("rc", F.sum(F.col("f").cast("int")).over(w).cast("bigint"))
    assert sorted(got.select("k", "t", "rc").collect()) == sorted(ref.select("k", "t", "rc").collect())


def test_train_or_sample_and_prefix(spark):
    a, b = spark.range(3), spark.range(1)
    assert P.train_or_sample(a, b, True).count() == 1
    assert P.train_or_sample(a, None, True).count() == 3
    assert P.train_or_sample(a, b, False).count() == 3
    pos = spark.range(19).withColumnRenamed("id", "pos")
    assert P.battery_prefix(pos).count() == 5


def test_dedup_equals_plain_rule_and_keeps_unique_texts_unshuffled(spark, corpus_fixture):
    pdf = corpus_fixture.toPandas().sort_values("id").drop_duplicates(["instruction", "response"])
    assert sorted(r["id"] for r in P.dedup_pairs(corpus_fixture).collect()) == sorted(pdf["id"])
    hot = spark.range(5000).select("id", F.lit("same q").alias("instruction"),
                                   F.when(F.col("id") % 3 == 0, "same a").otherwise(
                                       F.col("id").cast("string")).alias("response"))
    got = P.dedup_pairs(hot)
    assert got.count() == 1 + 5000 - 1667 and got.where("response = 'same a'").collect()[0]["id"] == 0
    nulls = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "x", None), (4, "null", "x")], "id long, instruction string, response string")
    assert sorted(r["id"] for r in P.dedup_pairs(nulls).collect()) == [1, 3, 4]


def plain_dedup(rows):
    """pandas: first of each (instruction, response) in key order, rows without a key last."""
    pdf = pd.DataFrame(rows, columns=["id", "instruction", "response"])
    return sorted(map(str, pdf.sort_values("id", kind="stable", na_position="last").drop_duplicates(["instruction", "response"]).itertuples(index=False, name=None)))


@pytest.mark.parametrize("fewest", [4, 1 << 40])
def test_dedup_with_repeated_and_null_keys(spark, monkeypatch, fewest):
    monkeypatch.setattr(bloom, "FEWEST_BITS_PER_VALUE", fewest)  # the second: rows are told by a join with the digests
    rows = [(1, "q", "a"), (1, "q", "a"), (0, "A", "x"), (7, "A", "x"), (7, "B", "y"), (None, "n", "n"), (None, "n", "n")]
    more = rows + [(None, "q", "a"), (3, None, "x"), (2, None, "x"), (4, None, None), (5, None, None), (6, "", None), (8, "null", "x"), (9, "q", "A")]
    r = random.Random(2)
    wild = [(r.choice([None, *range(9)]), r.choice([None, "", "a", "b", "long " * 300]), r.choice([None, "", "a", "c"])) for _ in range(400)]
    for given in (rows, more, wild, [], rows[:1]):
        given = [(None if k is None else float(k), i, a) for k, i, a in given]
        df = spark.createDataFrame(given, "id double, instruction string, response string").repartition(4)
        got = [(x["id"], x["instruction"], x["response"]) for x in P.dedup_pairs(df).collect()]
        plain = pd.DataFrame(got, columns=["id", "instruction", "response"])
        assert sorted(map(str, plain.itertuples(index=False, name=None))) == plain_dedup(given)


def test_dedup_shuffles_texts_of_candidates_only(spark):
    n, copies = 20_000, 300
    df = spark.range(n).select("id", F.concat(F.lit("question "), (F.col("id") % (n - copies)).cast("string")).alias("instruction"), F.lit("x" * 200).alias("response"))
    df = materialize(df.repartition(4), "pairs")
    candidates, others = P.duplicate_candidates(df)
    many = candidates.count()
    assert 2 * copies <= many <= 2 * copies + 0.02 * n and many + others.count() == n
    out = P.dedup_pairs(df)
    assert out.count() == n - copies
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the texts' only exchange lies below the window over candidates, and no join moves them
    assert plan.count("Exchange hashpartitioning(_pd") == 1 and "Join" not in plan.split("Subquery")[0]
    bits = bloom.bits_for(copies)
    values = df.select(P.pair_digest(["instruction", "response"]).alias("_pd"))
    some = bloom.bloom_filter(values.limit(copies), "_pd", bits)
    assert some.count() == 1 and len(some.first()["words"]) == bits // 64


def test_split_cuts_equal_the_global_rank(spark):
    for n, digits, few in [(0, 2, 10), (1, 1, 0), (10, 1, 1), (997, 2, 3), (3000, 1, 1), (2000, 4, 1000)]:
        df = spark.range(n).repartition(3)
        ranks = lambda m: [P.split_counts(m)[2], P.split_counts(m)[2] + P.split_counts(m)[1]] if m else [0, 0]
        a, b = rank_cuts(df, order_hash(42, ["id"]), ["id"], ranks, digits, few)
        out = P.with_split(df, P.SplitCuts(42, ("id",), a, b))
        assert {r["id"]: r["split"] for r in out.collect()} == (_global_rank_split(df) if n else {})
        assert "Exchange" not in P.with_split(spark.range(n), P.SplitCuts(42, ("id",), a, b))._jdf.queryExecution().executedPlan().toString()
    df = spark.range(500)
    cuts = P.split_cuts(df)
    part = {r["id"]: r["split"] for r in P.with_split(df.where("id % 7 = 3"), cuts).collect()}  # a part alone is labelled alike
    whole = {r["id"]: r["split"] for r in P.with_split(df, cuts).collect()}
    assert part == {i: s for i, s in whole.items() if i % 7 == 3}


def test_split_of_a_stream(spark):
    df = materialize(spark.range(300).repartition(3), "ids")
    cuts = P.split_cuts(df)
    path = scratch_path(spark, "ids-stream")
    df.write.parquet(path)
    live = P.with_split(spark.readStream.schema("id long").parquet(path), cuts)
    got = {r["id"]: r["split"] for r in run_available(live, spark, "split-stream").collect()}
    assert got == {r["id"]: r["split"] for r in P.with_split(df, cuts).collect()}


def test_label_vocabulary_keeps_values_without_a_key(spark):
    df = spark.createDataFrame([(1, "c", "i"), (None, "only", "i"), (None, "c", "late"), (None, None, "i")], "id long, category string, intent string")
    got = {(r["field"], r["value"]): r["position"] for r in P.label_vocabulary(df).collect()}
    assert got == {("category", "c"): 1, ("category", "only"): 2, ("category", None): 3, ("intent", "i"): 1, ("intent", "late"): 2}
    assert dict(P.label_vocabulary(df).dtypes)["position"] == "bigint"


def test_shuffled_positions_follow_the_seeded_order(spark):
    df = spark.range(3000).withColumnRenamed("id", "idx")
    a = {r["idx"]: r["shuffle_pos"] for r in P.shuffled(df, keys=["idx"]).collect()}
    b = {r["idx"]: r["shuffle_pos"] for r in P.shuffle_take(df, 3000, keys=["idx"]).collect()}
    assert a == b


def test_label_vocabulary_fallback_chain(spark, corpus_fixture):
    from parley.functions.constants import DEFAULT_INTENTS
    empty = corpus_fixture.limit(0)
    got = P.label_vocabulary_or_default(empty, corpus_fixture)
    assert got.where("field = 'intent'").count() == 6  # raw used: prepared is empty
    no_labels = corpus_fixture.drop("intent")
    got2 = P.label_vocabulary_or_default(no_labels, None)
    intents = [r["value"] for r in got2.where("field = 'intent'").orderBy("position").collect()]
    assert intents == DEFAULT_INTENTS
    assert P.label_vocabulary_or_default(corpus_fixture, empty).where("field = 'category'").count() == 5
