"""Most frequent tokens without counting all distinct ones: Misra-Gries summaries, then an exact count.

Every task keeps at most ``counters`` tokens with lower bounds of their counts; whenever there are more, the
count of the first one too many is taken from all, and what is not above zero goes.  The sum of these
cuts over all tasks, the loss, bounds how far any bound is below the true count, and the count of every token that
no summary holds.  So if the ``limit``-th largest bound is above the loss, the ``limit`` most frequent
tokens (with all ties) are among the tokens whose bound and loss reach it, and only these are counted, in a second
scan behind a Bloom filter.  If not, more counters are tried, then all tokens are counted: the counts are
exact in every case.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bloom import bits_for, bloom_filter, may_hold
from ..session import materialize

COUNTERS = 1 << 18  # held by a task
MORE = 8  # times as many in the second attempt
SLICE = 512  # tokens of a row that goes to the summaries: long texts are cut, so batches stay bounded


def _cut_to(counters: int, held: pa.Table) -> tuple[pa.Table, int]:
    """The sums by token, cut to ``counters`` tokens, and what was taken from each."""
    held = held.group_by("token").aggregate([("n", "sum")]).rename_columns(["token", "n"])
    if held.num_rows <= counters:
        return held, 0
    best = pc.select_k_unstable(held["n"], counters + 1, [("", "descending")])
    cut = held["n"][best[counters].as_py()].as_py()
    held = held.set_column(1, "n", pc.subtract(held["n"], cut))
    return held.filter(pc.greater(held["n"], 0)), cut


def summaries(df: DataFrame, tokens: Column, counters: int = COUNTERS) -> DataFrame:
    """``(token, n)``: per task up to ``counters`` lower bounds, and a row without token that holds the loss."""
    at = F.transform(F.sequence(F.lit(0), F.floor((F.size("_t") - 1) / SLICE)), lambda i: F.slice("_t", (i * SLICE + 1).cast("int"), SLICE))
    slices = df.select(tokens.alias("_t")).where(F.size("_t") > 0).select(F.explode(at).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"token": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        lost, waiting, rows = 0, [], 0
        for b in batches:
            found = pc.value_counts(b.column(0).flatten().cast(pa.string()))
            waiting.append(pa.table({"token": found.field(0), "n": found.field(1)}))
            rows += len(found)
            if rows > counters:
                held, cut = _cut_to(counters, pa.concat_tables([held, *waiting]))
                lost, waiting, rows = lost + cut, [], 0
        held, cut = _cut_to(counters, pa.concat_tables([held, *waiting]))
        yield from held.combine_chunks().to_batches()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([lost + cut], pa.int64())], names=["token", "n"])

    return slices.mapInArrow(run, "token string, n bigint")


def count_at(counts: DataFrame, limit: int) -> int | None:
    """The ``limit``-th largest ``n``; None if there are fewer rows.  The window holds a row per distinct count."""
    per = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_m"))
    upto = F.sum("_m").over(Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0))
    return per.withColumn("_upto", upto).where(F.col("_upto") >= limit).agg(F.max("n")).first()[0]


def frequent_counts(df: DataFrame, tokens: Column, limit: int, counters: int = COUNTERS) -> DataFrame:
    """``(token, n)`` with exact counts: the ``limit`` most frequent tokens, all ties of the last one, and some more.

    Null tokens are not counted.  ``df`` is scanned once if the summaries can hold all its tokens, else twice.
    """
    words = df.select(F.explode(tokens).alias("token")).where(F.col("token").isNotNull())

    def exact(of: DataFrame) -> DataFrame:
        return of.groupBy("token").agg(F.count(F.lit(1)).alias("n"))

    for held in (counters, counters * MORE):
        found = materialize(summaries(df, tokens, held).groupBy("token").agg(F.sum("n").alias("n")), "summaries")
        lost = found.where(F.col("token").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        low = found.where(F.col("token").isNotNull())
        if lost == 0:
            return low
        least = count_at(low, limit)
        if least is None or least <= lost:
            continue
        candidates = materialize(low.where(F.col("n") + F.lit(lost) >= F.lit(least)).select("token"), "candidates")
        bits = bits_for(candidates.count())
        if bits is not None:
            filter_ = materialize(bloom_filter(candidates, "token", bits), "candidate-filter")
            words = words.where(may_hold(filter_, F.col("token"), bits))
        return materialize(exact(words).join(candidates, "token", "left_semi"), "frequent-counts")
    return materialize(exact(words), "token-counts")


def most_frequent(df: DataFrame, tokens: Column, k: int, counters: int = COUNTERS) -> DataFrame:
    """AGG-4 / AGG-5 over tokens: the ``k`` most frequent ones, ties by token: ``(token, n)``."""
    return frequent_counts(df, tokens, k, counters).orderBy(F.col("n").desc(), "token").limit(k)
