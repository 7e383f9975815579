"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import scratch_root

WS = " \t\n\x0b\x0c\r"
HEAVY = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: recomputed by no later job."""
    path = f"{scratch_root(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tasks(spark: SparkSession, factor: int = 1) -> int:
    """A task count for an explicit repartition: the session's shuffle partitions times ``factor``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * factor)


def sampled_labels(labels: DataFrame, column: str, rows: int, keep: Column | None = None) -> DataFrame:
    """At most ``2 * rows`` (expected ``rows``) labelled ids: (doc_id, label), chosen by a hash of doc_id.

    Repeated ids count once, with their smallest label; null ids and labels are left out.  The
    choice is a hash threshold from the row count, so no task sorts or merges the whole table; the
    final limit never bites in practice and proves the bound of a broadcast.
    """
    ids = labels.select("doc_id", F.col(column).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if keep is not None:
        ids = ids.where(keep)
    ids = ids.groupBy("doc_id").agg(F.min("label").alias("label"))
    share = min(1.0, rows / max(1, ids.count()))
    chosen = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return ids.where(chosen).limit(2 * rows)


def joined(left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None, heavy: int = HEAVY) -> DataFrame:
    """Left join on ``key``, unique in ``right``, that does not shuffle the rows of the ``heavy`` most frequent keys.

    Their rows of ``right`` are broadcast: at most ``heavy``.  Any other key has at most one in ``heavy`` of all rows.
    ``counts`` (key, n) says how often a key occurs in ``left``, if that is known.
    """
    if counts is None:
        counts = written(left.groupBy(key).agg(F.count("*").alias("n")), "key-counts")
    hot = counts.where(F.col(key).isNotNull()).orderBy(F.desc("n"), key).limit(heavy).select(F.col(key).alias("_j_hot"))
    columns = [c for c in right.columns if c != key]
    both = right.join(F.broadcast(hot), F.col(key) == F.col("_j_hot"), "left")
    near = both.where("_j_hot is not null").select("_j_hot", *[F.col(c).alias(f"_j_near_{c}") for c in columns])
    far = both.where("_j_hot is null").select(F.col(key).alias("_j_far"), *[F.col(c).alias(f"_j_far_{c}") for c in columns])
    # a key without a row in ``right`` is joined below, too, where it finds nothing
    rows = left.join(F.broadcast(near), F.col(key) == F.col("_j_hot"), "left")
    # rows that are done meet nothing: a null key, which an outer join would gather, is spread
    spread = F.xxhash64(F.monotonically_increasing_id())
    rows = rows.withColumn("_j_key", F.when(F.col("_j_hot").isNull(), F.col(key))).withColumn("_j_spread", F.when(F.col("_j_key").isNull(), spread).otherwise(F.lit(0)))
    rows = rows.join(far.withColumn("_j_zero", F.lit(0).cast("long")), (F.col("_j_key") == F.col("_j_far")) & (F.col("_j_spread") == F.col("_j_zero")), "left")
    return rows.select(*[F.col(f"`{c}`") for c in left.columns], *[F.coalesce(f"_j_near_{c}", f"_j_far_{c}").alias(c) for c in columns])
