"""SNK-2 / SRC-6 laid out for joins: tables bucketed and sorted by their keys.

Rows of equal keys lie in one bucket, so a join or grouping by the keys reads the buckets as they are,
without an exchange of the saved side.  Beside the table a small document tells its layout, so that
:func:`open_bucketed` finds it again in another session.  Keys should be close to unique (a pair's id, a digest,
a conversation and turn): all rows of a key are read by one task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.bloom import bits_for, bloom_filter, may_hold
from ..session import materialize

BUCKETS = 64  # of a local table; a cluster's table takes about one for 200 MB


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}-layout"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, mode: str = "overwrite") -> DataFrame:
    """Writes ``df`` bucketed by ``keys`` and opens it.  One exchange puts every bucket into one file."""
    name = f"bucketed_{uuid.uuid4().hex}"
    if mode == "append":  # into the table that lies there: its own layout counts
        had = open_bucketed(df.sparkSession, path)
        df.select(*had.columns).repartition(buckets, *keys).write.mode("append").insertInto(_name_of(df.sparkSession, path))
        return open_bucketed(df.sparkSession, path)
    out = df.repartition(buckets, *keys).write.mode(mode).format("parquet").option("path", path)
    out.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    layout = json.dumps({"keys": list(keys), "buckets": buckets, "schema": json.loads(df.schema.json())})
    df.sparkSession.createDataFrame([(layout,)], "value string").coalesce(1).write.mode("overwrite").text(_layout_path(path))
    return df.sparkSession.table(name)


def _name_of(spark: SparkSession, path: str) -> str:
    """A new name in the session's catalog for the table that lies at ``path``."""
    layout = json.loads(spark.read.text(_layout_path(path)).first()[0])
    schema, name = StructType.fromJson(layout["schema"]), f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    at = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(layout['keys'])}) "
              f"SORTED BY ({_quoted(layout['keys'])}) INTO {layout['buckets']} BUCKETS LOCATION '{at}'")
    return name


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`write_bucketed` wrote, with its layout."""
    return spark.table(_name_of(spark, path))


# --- pairs seen before ----------------------------------------------------------------------


def digest(subset: Sequence[str]) -> Column:
    """md5 over the length-prefixed texts of ``subset``; null is told from the empty text."""
    parts = []
    for c in subset:
        text = F.col(c).cast("string")
        parts += [F.coalesce(F.char_length(text), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat(*parts))


def save_seen(df: DataFrame, path: str, subset: Sequence[str] = ("instruction", "response"), buckets: int = BUCKETS,
              mode: str = "overwrite") -> DataFrame:
    """The index of pairs seen: their distinct digests, bucketed.  ``append`` adds those of a new part."""
    return write_bucketed(df.select(digest(subset).alias("digest")).distinct(), path, ["digest"], buckets, mode)


def drop_seen(df: DataFrame, index: DataFrame, subset: Sequence[str] = ("instruction", "response")) -> DataFrame:
    """DST-1 against a saved index: the rows of ``df`` whose pair is not in it.

    Digests of the new rows meet the index bucket by bucket; those found go into a Bloom filter tested at the scan,
    so only rows that pass it are shuffled with their texts, for the exact test.
    """
    seen = materialize(df.select(digest(subset).alias("digest")).distinct().join(index, "digest", "left_semi"), "seen")
    marked, bits = df.withColumn("digest", digest(subset)), bits_for(seen.count())
    if bits is None:
        return marked.join(seen, "digest", "left_anti").select(*df.columns)
    maybe = may_hold(materialize(bloom_filter(seen, "digest", bits), "seen-filter"), F.col("digest"), bits)
    exact = marked.where(maybe).join(seen, "digest", "left_anti")
    return marked.where(~maybe).select(*df.columns).unionByName(exact.select(*df.columns))
