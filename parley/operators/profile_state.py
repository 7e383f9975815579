"""AGG-1, AGG-3, AGG-6 and AGG-7 kept up to date: mergeable state for each part of the input.

A part (a day's folder, a delivery) is scanned once.  Its state holds, per column, the rows, the rows with a
value and a HyperLogLog sketch of the values, and, per text column, the counts of its lengths.  Counts add
up and sketches unite, so the profile of all parts is read from their states alone: a new part costs one
scan of that part, a changed one overwrites its own state, and a dropped one is left out.

Rows, non-null counts, length statistics and histograms equal those of a full scan.  Distinct counts
are estimates with a relative standard error of ``SKETCH_ERROR``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKETCH_LG_K = 14  # 2**14 registers: 16 KiB for a column and part
SKETCH_ERROR = 1.04 / (1 << (SKETCH_LG_K // 2))
STATE = "kind string, field string, len bigint, rows bigint, present bigint, sketch binary"


def _counted(df: DataFrame, text_columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row per column (``kind`` cells) and per text column and length (``kind`` length), for each value of ``by``.

    Values enter the sketches as 64-bit hashes, so what is aggregated (within tasks first) is narrow.
    """
    none = F.lit(None).cast("bigint")
    cells = [F.struct(F.lit("cells").alias("kind"), F.lit(c).alias("field"), none.alias("len"),
                      F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`").cast("string"))).alias("value")) for c in df.columns if c not in by]
    lengths = [F.struct(F.lit("length").alias("kind"), F.lit(c).alias("field"), F.char_length(F.col(f"`{c}`")).cast("bigint").alias("len"),
                        none.alias("value")) for c in text_columns if c in df.columns]
    return (df.select(*by, F.explode(F.array(*cells, *lengths)).alias("s")).select(*by, "s.*")
            .where((F.col("kind") == "cells") | F.col("len").isNotNull())
            .groupBy(*by, "kind", "field", "len")
            .agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("present"),
                 F.hll_sketch_agg("value", SKETCH_LG_K).alias("sketch"))
            .withColumn("sketch", F.when(F.col("kind") == "cells", F.col("sketch"))))


def part_state(df: DataFrame, text_columns: Sequence[str] = ("instruction", "response")) -> DataFrame:
    """State of one part, in one scan.  A part without rows has a row per column, too."""
    counted = _counted(df, text_columns)
    columns = df.sparkSession.createDataFrame([("cells", c, None, 0, 0, None) for c in df.columns], STATE)
    return counted.unionByName(columns)


def save_part(df: DataFrame, part: str, path: str, text_columns: Sequence[str] = ("instruction", "response")) -> None:
    """Writes the state of a part; an earlier state of the same part is overwritten, so a repeated call changes nothing."""
    part_state(df, text_columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={quote(part, safe='')}")


def save_parts(df: DataFrame, by: Column, path: str, text_columns: Sequence[str] = ("instruction", "response")) -> None:
    """Writes the states of all parts that a delivery holds in one scan; ``by`` names each row's part.

    States of the same parts are overwritten, those of others stay.  ``df`` has no column ``part`` of its own.
    """
    states = _counted(df.withColumn("part", by.cast("string")), text_columns, ["part"])
    (states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def read_state(spark: SparkSession, path: str, only: Iterable[str] | None = None) -> DataFrame:
    """The saved states with their ``part`` (all, or those of the parts in ``only``); none if nothing was saved yet."""
    try:
        state = spark.read.schema(f"{STATE}, part string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        state = spark.createDataFrame([], f"{STATE}, part string")
    return state if only is None else state.where(F.col("part").isin(*only))


def update(spark: SparkSession, path: str, parts: Mapping[str, DataFrame],
           text_columns: Sequence[str] = ("instruction", "response")) -> list[str]:
    """Scans the parts that have no state yet and returns their names."""
    known = {r["part"] for r in read_state(spark, path).select("part").distinct().collect()}  # names of parts only
    new = [p for p in parts if p not in known]
    for p in new:
        save_part(parts[p], p, path, text_columns)
    return new


def merged_counts(state: DataFrame) -> DataFrame:
    """AGG-1, AGG-2's counts and AGG-3: ``(field, rows, non_null, distinct)``; ``distinct`` is an estimate.

    ``rows`` are those of the parts that have the column.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return state.where(F.col("kind") == "cells").groupBy("field").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("non_null"), F.coalesce(united, F.lit(0)).cast("bigint").alias("distinct"))


def merged_shape(state: DataFrame) -> DataFrame:
    """AGG-1 of all parts: ``(rows, columns)``, counting a column that only some parts have."""
    return merged_counts(state).agg(F.coalesce(F.max("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("columns"))


def merged_lengths(state: DataFrame) -> DataFrame:
    """``(field, len, cnt)`` of all parts, for ``profile.stats_of_lengths`` and ``profile.bins_of_lengths``."""
    return state.where(F.col("kind") == "length").groupBy("field", "len").agg(F.sum("rows").alias("cnt"))
