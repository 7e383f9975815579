"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
only read it.  When it is unset (local runs, tests) a fresh folder is made
once per session with ``mktemp``-style naming and registered as the
checkpoint directory, so later ``checkpoint()`` calls and stream checkpoints
land in the same place.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "parley") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings a cluster job of this library is meant to run with (applied by the
# job's submitter, not by the library).  Shuffle partitions are sized by AQE
# from ~128 MB advisory partitions; skewed partitions are split.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # keyed chat history state lives in RocksDB on local disk, checkpointed to the shared folder
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and written tables.

    Reads ``spark.checkpoint.dir`` (SparkConf first, then the session's SQL
    conf, then the context's registered checkpoint dir).  Only when none is set
    on a local master does it create a folder and register it; elsewhere it raises,
    since machines would not see each other's files.
    """
    found = None
    try:
        found = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup on remote sessions
        found = None
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect: no context on the client
        sc = None
    if sc is not None:
        found = found or sc.getConf().get("spark.checkpoint.dir", None)
        if not found:
            opt = sc._jsc.sc().getCheckpointDir()
            if opt.isDefined():
                found = opt.get()
    if not found:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused sub-folder of the scratch root."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as Parquet below the shared scratch root and read it back.

    Cuts the lineage of an expensive intermediate (the cleaned, split corpus;
    a bank) that several plans consume: a lost executor then recomputes from
    the written files, not from the raw scan, dedup and ranking again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
