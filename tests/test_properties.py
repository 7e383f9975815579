"""Property tests: Spark operators against small pure-Python models of the rules."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions.lexicon import lexicon_frame
from parley.operators import prepare as P
from parley.operators import profile as R
from parley.operators import respond as A
from parley.sources import files as IO

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

words = st.sampled_from(["ab", "ba", "order", "ord", "cancel", "x", "AB", "o r"])
texts = st.lists(st.lists(words, max_size=6).map(" ".join), min_size=1, max_size=12)
lexicons = st.lists(st.tuples(st.sampled_from(["i1", "i2", "i3", "i4"]),
                              st.lists(st.sampled_from(["ab", "order", "ord", "x", "o r", "b"]),
                                       min_size=1, max_size=3, unique=True)),
                    min_size=1, max_size=4, unique_by=lambda t: t[0])


def model_intent(text, lexicon):
    low = text.lower()
    best, best_score = "general", 0
    for intent, kws in lexicon:
        score = sum(1 for k in kws if k in low)
        if score > best_score:
            best, best_score = intent, score
    return best, best_score


@settings(**SETTINGS)
@given(texts=texts, lexicon=lexicons)
def test_classify_compiled_and_join_equal_model(spark, texts, lexicon):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, query string")
    comp = {r["id"]: (r["intent"], r["score"]) for r in
            A.classify_intent(df, "query", lexicon, score_col="score").collect()}
    join = {r["id"]: (r["intent"], r["score"]) for r in
            A.classify_intent_join(df, lexicon_frame(spark, lexicon), "query", ["id"], score_col="score").collect()}
    want = {i: model_intent(t, lexicon) for i, t in enumerate(texts)}
    assert comp == want and join == want


def model_parse(line):
    q = line.strip(" \t\n\r\f")
    return q.split(". ", 1)[1] if ". " in q else q


@settings(**SETTINGS)
@given(lines=st.lists(st.text(alphabet=" .\t1a", max_size=12), min_size=1, max_size=10))
def test_numbered_parse_equals_model(spark, lines):
    df = spark.createDataFrame(pd.DataFrame({"value": lines}))
    got = [r["question"] for r in IO.parse_numbered_questions(df).collect()]
    assert got == [model_parse(x) for x in lines]


@settings(**SETTINGS)
@given(lens=st.lists(st.integers(0, 60), min_size=1, max_size=40), bins=st.integers(1, 12))
def test_histogram_equals_numpy(spark, lens, bins):
    df = spark.createDataFrame(pd.DataFrame({"instruction": ["x" * n for n in lens]}))
    got = R.length_histogram(df, ["instruction"], bins).orderBy("bin").toPandas()
    counts, edges = np.histogram(lens, bins=bins)
    assert list(got["n"]) == list(counts)
    assert np.allclose(got["lo_edge"], edges[:-1])


@settings(**SETTINGS)
@given(n=st.integers(0, 400), digits=st.integers(1, 3), seed=st.integers(0, 99))
def test_split_sizes_exact(spark, n, digits, seed):
    sp = P.split_train_val_test(spark.range(n), ["id"], seed, hex_digits=digits)
    got = {r["split"]: r["c"] for r in sp.groupBy("split").agg(F.count(F.lit(1)).alias("c")).collect()}
    train, val, test = P.split_counts(n)
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == (train, val, test)


@settings(**SETTINGS)
@given(lens=st.lists(st.integers(0, 80), min_size=2, max_size=60))
def test_length_stats_equal_pandas(spark, lens):
    df = spark.createDataFrame(pd.DataFrame({"instruction": ["y" * n for n in lens]}))
    r = R.length_stats(df, ["instruction"]).collect()[0]
    d = pd.Series(lens).describe()
    for k, name in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                    ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert abs(r[k] - d[name]) < 1e-9, (k, r[k], d[name])
    assert r["count"] == len(lens)
