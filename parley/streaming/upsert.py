"""Keyed results of a stream as a versioned, key-bucketed table.

Every micro-batch of an update-mode stream writes the keys that changed in it, and only these, as one
version: ``version=<batch>/bucket=<hash of the key>``.  A replayed batch overwrites its own version, so it
changes nothing.  Readers take the latest version of each key; a lookup of few keys reads their buckets
only.  :func:`compact` folds all versions into one, in a new folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_version(batch: DataFrame, version: int, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """The rows of one micro-batch (unique in ``keys``) as one version; the same version is overwritten.

    The rows of a bucket go to one task first, so a version has a file a bucket and not one for each
    bucket in each task of the batch.
    """
    rows = batch.withColumn("bucket", bucket_of(keys, buckets)).repartition(buckets, "bucket")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")


def upsert_available(stream: DataFrame, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS,
                     checkpoint: str | None = None) -> list[dict]:
    """Runs a streaming aggregation in update mode over everything available now into ``path``.

    Goes on from ``checkpoint`` if that is given; returns the progress of its micro-batches.
    """
    query = (stream.writeStream.outputMode("update").foreachBatch(lambda batch, epoch: write_version(batch, epoch, path, keys, buckets))
             .option("checkpointLocation", checkpoint or scratch_path(spark, "upsert-chk")).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return [dict(p) for p in query.recentProgress]


def versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of all versions, with ``version`` and ``bucket``; none if nothing was written yet."""
    whole = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], only: DataFrame | None = None,
           buckets: int = BUCKETS) -> DataFrame:
    """The row of the latest version of every key, or of the keys in ``only`` (by a partition filter)."""
    rows = versions(spark, path, schema)
    if only is not None:
        wanted = [r[0] for r in only.select(bucket_of(keys, buckets)).distinct().collect()]  # at most ``buckets``
        rows = rows.where(F.col("bucket").isin(wanted)).join(only.select(*keys), list(keys), "left_semi")
    rest = [f.name for f in schema.fields if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_last"))
    return last.select(*[F.col("_last")[f.name].alias(f.name) if f.name in rest else F.col(f.name) for f in schema.fields])


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], out: str, buckets: int = BUCKETS) -> str:
    """Writes the latest rows as one version, numbered as the last one, below ``out``.

    A stream that goes on from its checkpoint with ``out`` as its table adds later versions to it.
    """
    last = versions(spark, path, schema).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    write_version(latest(spark, path, schema, keys), last, out, keys, buckets)
    return out
