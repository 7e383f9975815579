"""Corpus profiling: shape, types, distinct counts, top values, value counts,
length statistics and length histograms.

Plan shapes chosen for scale:

* distinct counts and top values work on an unpivoted ``(column, value)``
  stream instead of one pass per column; long values are shuffled only as
  digests (partial aggregation collapses hot values before the shuffle);
* length statistics and exact linear-interpolated quantiles come from a
  ``(column, length, count)`` histogram: the data is aggregated once, and the
  windows run over the histogram, whose size is bounded by the longest text,
  not by the number of rows (no exact-percentile buffer of all values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import HISTOGRAM_BINS, LOW_CARDINALITY, TOP_VALUES

QUANTILES = (0.25, 0.5, 0.75)


def with_lengths(df: DataFrame, columns: Sequence[str] = ("instruction", "response")) -> DataFrame:
    """The profiled frame: ``<col>_length`` (bigint code-point count) for each text column present."""
    out = df
    for c in columns:
        if c in df.columns:
            out = out.withColumn(f"{c}_length", F.char_length(c).cast("bigint"))
    return out


def shape(df: DataFrame) -> DataFrame:
    """AGG-1: one row ``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint"))


def column_types(df: DataFrame) -> DataFrame:
    """AGG-2: ``(position, field, type, non_null)``: Spark type names and how
    many rows have a value, in one aggregation over the table."""
    rows = [(i + 1, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    types = df.sparkSession.createDataFrame(rows, "position int, field string, type string")
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    one = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("bigint").alias("non_null")) for c in df.columns])).alias("s"))
    return types.join(one.select("s.*"), "field").select("position", "field", "type", "non_null")


def stacked_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(field, value)``: every cell as text, one row per (row, column)."""
    cols = list(columns or df.columns)
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*")


def value_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(field, value, n)``: count per distinct value of every column (values as text, nulls kept)."""
    return stacked_values(df, columns).groupBy("field", "value").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def _all_fields(spark, columns: Sequence[str], counted: DataFrame) -> DataFrame:
    fields = spark.createDataFrame([(c,) for c in columns], "field string")
    return fields.join(counted, "field", "left").select(
        "field", F.coalesce(F.col("distinct"), F.lit(0)).cast("bigint").alias("distinct"))


def _digest_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, h)``: one row per distinct non-null value, as its 16-byte md5."""
    st = stacked_values(df, columns).where(F.col("value").isNotNull())
    return st.groupBy("field", F.unhex(F.md5("value")).alias("h")).agg(F.count(F.lit(1)).alias("_n"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG-3: distinct non-null values of every column (0 for an empty table).

    Values are told apart by their 16-byte md5, so the shuffle moves digests,
    not documents (exact unless two different values share an md5).
    """
    cols = list(columns or df.columns)
    counted = _digest_table(df, cols).groupBy("field").agg(F.count(F.lit(1)).cast("bigint").alias("distinct"))
    return _all_fields(df.sparkSession, cols, counted)


def distinct_counts_approx(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.01) -> DataFrame:
    """AGG-3, approximate: HyperLogLog++ per column straight over the stacked
    cells.  Each task ships one sketch per column, so long text columns are
    never shuffled; relative standard deviation ``rsd``."""
    return stacked_values(df, columns).groupBy("field").agg(
        F.approx_count_distinct("value", rsd).cast("bigint").alias("distinct"))


def top_values(df: DataFrame, k: int = TOP_VALUES, low_cardinality: int = LOW_CARDINALITY,
               always: Sequence[str] = ("category", "intent")) -> DataFrame:
    """AGG-4: top ``k`` non-null values of each column that is in ``always`` or has
    fewer than ``low_cardinality`` distinct values; ties broken by value.

    ``(field, rank, value, n)``.  Which columns qualify comes from the digest
    counts (one row per column, broadcast); values are counted only for those,
    which by definition have few distinct values or are the label columns.
    The per-column window keeps at most ``k`` rows per column and task before
    its shuffle (WindowGroupLimit).
    """
    eligible = distinct_counts(df).where(
        F.col("field").isin(*always) | (F.col("distinct") < low_cardinality)).select("field")
    cells = stacked_values(df).where(F.col("value").isNotNull()).join(F.broadcast(eligible), "field")
    counted = cells.groupBy("field", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value"))
    return (counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("field", "rank", "value", "n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """AGG-5: all non-null value counts of one column, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .orderBy(F.col("n").desc(), F.col(column)))


def length_histogram_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, len, cnt)`` for the character length of each text column (nulls skipped)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.char_length(c).cast("bigint").alias("len")) for c in columns
    ])).alias("s")).select("s.*").where(F.col("len").isNotNull())
    return stacked.groupBy("field", "len").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))


def length_stats(df: DataFrame, columns: Sequence[str] = ("instruction", "response")) -> DataFrame:
    """AGG-6: per text column: count, mean, sample std, min, 25/50/75 % (linear
    interpolation, as NumPy/pandas), max of the character length."""
    return stats_of_lengths(length_histogram_table(df, columns))


def stats_of_lengths(hist: DataFrame) -> DataFrame:
    """AGG-6 from a ``(field, len, cnt)`` table, however it came about."""
    per = Window.partitionBy("field")
    run = per.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)
    h = (hist.withColumn("_n", F.sum("cnt").over(per))
         .withColumn("_cum", F.sum("cnt").over(run))
         .withColumn("_mean", F.sum(F.col("len") * F.col("cnt")).over(per) / F.col("_n")))
    aggs = [
        F.first("_n").alias("count"),
        F.first("_mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.col("cnt") * F.pow(F.col("len") - F.col("_mean"), 2)),
                            (F.first("_n") - 1).cast("double"))).alias("std"),
        F.min("len").cast("double").alias("min"),
        F.max("len").cast("double").alias("max"),
    ]
    for j, q in enumerate(QUANTILES):
        pos = (F.col("_n") - 1) * F.lit(q)
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        aggs += [
            F.min(F.when(F.col("_cum") > lo_i, F.col("len"))).alias(f"_lo{j}"),
            F.min(F.when(F.col("_cum") > hi_i, F.col("len"))).alias(f"_hi{j}"),
            F.first(pos - lo_i).alias(f"_fr{j}"),
        ]
    out = h.groupBy("field").agg(*aggs)
    for j, name in enumerate(("p25", "p50", "p75")):
        lo, hi, fr = F.col(f"_lo{j}"), F.col(f"_hi{j}"), F.col(f"_fr{j}")
        out = out.withColumn(name, lo + (hi - lo) * fr)
    return out.select("field", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def length_histogram(df: DataFrame, columns: Sequence[str] = ("instruction", "response"),
                     bins: int = HISTOGRAM_BINS) -> DataFrame:
    """AGG-7: ``bins`` equal-width bins from min to max per column, last bin
    closed, empty bins included: ``(field, bin, lo_edge, hi_edge, n)``.

    Bin edges are ``lo + k*(hi-lo)/bins`` and a value is moved across an edge
    when floating division put it on the wrong side, as NumPy does.  A column
    whose min equals max is widened to ``[x-0.5, x+0.5]``.
    """
    return bins_of_lengths(length_histogram_table(df, columns), bins)


def bins_of_lengths(hist: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """AGG-7 from a ``(field, len, cnt)`` table."""
    rng = (hist.groupBy("field").agg(F.min("len").alias("_lo0"), F.max("len").alias("_hi0"))
           .withColumn("_lo", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5)
                       .otherwise(F.col("_lo0").cast("double")))
           .withColumn("_hi", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5)
                       .otherwise(F.col("_hi0").cast("double")))
           .withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(bins))
           .select("field", "_lo", "_hi", "_step"))
    # one row per column: bounded, broadcast
    x = F.col("len").cast("double")
    raw_idx = F.least(F.floor((x - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                      F.lit(bins - 1))
    edge = lambda i: F.col("_lo") + i * F.col("_step")
    binned = (hist.join(F.broadcast(rng), "field")
              .withColumn("_i", raw_idx)
              .withColumn("_i", F.when(x < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
              .withColumn("_i", F.when((F.col("_i") < bins - 1) & (x >= edge(F.col("_i") + 1)),
                                       F.col("_i") + 1).otherwise(F.col("_i")))
              .groupBy("field", F.col("_i").cast("int").alias("bin"))
              .agg(F.sum("cnt").cast("bigint").alias("n")))
    grid = (rng.select("field", "_lo", "_step",
                       F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")))
    return (grid.join(binned, ["field", "bin"], "left")
            .select("field", "bin",
                    edge(F.col("bin")).alias("lo_edge"),
                    F.when(F.col("bin") == bins - 1, F.col("_lo") + F.lit(bins) * F.col("_step"))
                    .otherwise(edge(F.col("bin") + 1)).alias("hi_edge"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def profile_report(df: DataFrame, approx: bool = False) -> DataFrame:
    """SNK-5 content: ``(section, name, value, ord)`` rows: shape, column
    types and distinct counts (``ord`` = schema position); ``approx`` counts
    distinct values with HyperLogLog sketches.
    """
    counts = distinct_counts_approx(df) if approx else distinct_counts(df)
    pos = {name: i + 1 for i, name in enumerate(df.columns)}
    sh = shape(df)
    rows = sh.select(F.lit("shape").alias("section"), F.lit("rows").alias("name"),
                     F.col("rows").cast("string").alias("value"), F.lit(1).alias("ord"))
    cols = sh.select(F.lit("shape").alias("section"), F.lit("columns").alias("name"),
                     F.col("columns").cast("string").alias("value"), F.lit(2).alias("ord"))
    types = column_types(df).select(F.lit("type").alias("section"), F.col("field").alias("name"),
                                    F.col("type").alias("value"), F.col("position").alias("ord"))
    order_map = F.create_map(*[x for name, i in pos.items() for x in (F.lit(name), F.lit(i))])
    dcs = counts.select(
        F.lit("distinct").alias("section"), F.col("field").alias("name"),
        F.col("distinct").cast("string").alias("value"), order_map[F.col("field")].alias("ord"))
    return rows.unionByName(cols).unionByName(types).unionByName(dcs)
