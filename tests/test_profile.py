"""Profiling against pandas / NumPy on small fixtures."""

import numpy as np
import pandas as pd

from parley.operators import profile as R


def test_length_stats_match_pandas_describe(spark, corpus_fixture):
    out = {r["field"]: r for r in R.length_stats(corpus_fixture).collect()}
    pdf = corpus_fixture.toPandas()
    for col in ("instruction", "response"):
        d = pdf[col].dropna().map(len).describe()
        r = out[col]
        assert r["count"] == d["count"]
        for k, name in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                        ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert abs(r[k] - d[name]) < 1e-9, (col, k)


def test_length_stats_single_row_std_null(spark):
    df = spark.createDataFrame([("abc", "x")], "instruction string, response string")
    r = R.length_stats(df).collect()[0]
    assert r["std"] is None and r["p50"] == r["min"] == r["max"]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    lens = list(rng.integers(1, 300, 500)) + [0, 300, 150]
    texts = ["x" * int(n) for n in lens]
    df = spark.createDataFrame(pd.DataFrame({"instruction": texts, "response": ["same"] * len(texts)}))
    out = R.length_histogram(df).toPandas()
    counts, edges = np.histogram(lens, bins=50)
    ins = out[out.field == "instruction"].sort_values("bin")
    assert list(ins["n"]) == list(counts)
    assert np.allclose(ins["lo_edge"], edges[:-1]) and np.allclose(ins["hi_edge"], edges[1:])
    resp = out[out.field == "response"].sort_values("bin")  # min == max: all in the middle bin
    c2, _ = np.histogram([4] * len(texts), bins=50)
    assert list(resp["n"]) == list(c2) and resp["n"].iloc[25] == len(texts)


def test_distinct_and_top_values(spark, corpus_fixture):
    prof = R.with_lengths(corpus_fixture)
    dc = {r["field"]: r["distinct"] for r in R.distinct_counts(prof).collect()}
    pdf = prof.toPandas()
    for c in pdf.columns:
        assert dc[c] == pdf[c].nunique(), c
    top = R.top_values(prof).collect()
    fields = {r["field"] for r in top}
    # category/intent always; others only when fewer than 20 distinct values (all here)
    assert {"category", "intent", "flags"} <= fields
    intent_top = [(r["value"], r["n"]) for r in sorted((r for r in top if r["field"] == "intent"),
                                                        key=lambda r: r["rank"])]
    assert intent_top[0] == ("cancel_order", 3)
    assert all(v is not None for v, _ in intent_top)


def test_shape_types_report(spark, corpus_fixture):
    prof = R.with_lengths(corpus_fixture)
    assert R.shape(prof).collect()[0].asDict() == {"rows": 10, "columns": 8}
    types = R.column_types(prof).collect()
    assert [t["field"] for t in types][:2] == ["id", "flags"] and types[-1]["type"] == "bigint"
    rep = R.profile_report(prof).collect()
    assert {r["section"] for r in rep} == {"shape", "type", "distinct"} and len(rep) == 2 + 8 + 8


def test_value_counts_sorted(spark, corpus_fixture):
    rows = R.value_counts(corpus_fixture, "category").collect()
    assert [r["n"] for r in rows] == sorted([r["n"] for r in rows], reverse=True)
    assert rows[0]["category"] == "ORDER"


def test_distinct_counts_approx_close(spark):
    from pyspark.sql import functions as F
    df = spark.range(20000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 37).alias("b"))
    got = {r["field"]: r["distinct"] for r in R.distinct_counts_approx(df).collect()}
    assert got["b"] == 37 and abs(got["a"] - 20000) / 20000 < 0.05
    plan = R.distinct_counts_approx(df)._jdf.queryExecution().executedPlan().toString()
    assert "approx_count_distinct" in plan or "HyperLogLogPlusPlus" in plan


def test_distinct_counts_and_types_of_an_empty_table(spark, corpus_fixture):
    none = R.with_lengths(corpus_fixture).limit(0)
    assert {r["distinct"] for r in R.distinct_counts(none).collect()} == {0}
    assert {r["non_null"] for r in R.column_types(none).collect()} == {0}


def test_top_values_equal_counted_values(spark, corpus_fixture):
    prof = R.with_lengths(corpus_fixture)
    counted = R.value_table(prof).where("value is not null").toPandas().sort_values(["field", "n", "value"], ascending=[True, False, True])
    want = {(r.field, r.value, r.n) for f, g in counted.groupby("field") for r in g.head(10).itertuples()}
    assert {(r["field"], r["value"], r["n"]) for r in R.top_values(prof).collect()} == want
