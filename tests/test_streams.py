"""Answered once on a live feed, and the versioned table of a keyed stream."""

import os

from pyspark.sql import functions as F

from parley.functions.constants import STOCK_LEXICON
from parley.operators import bank as B
from parley.operators import evaluate as V
from parley.session import scratch_path
from parley.streaming import chat as S
from parley.streaming import upsert as U

TURNS = "conv_id long, turn long, role string, text string, sent_at timestamp"


def delivered(spark, folder, rows):
    """One file a delivery: rows (conv_id, turn, hour)."""
    data = [(c, t, "user", f"cancel order {c}", h) for c, t, h in rows]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, hour long")
    df.select("conv_id", "turn", "role", "text", F.timestamp_seconds(1_700_000_000 + F.col("hour") * 3600).alias("sent_at")).coalesce(1).write.mode("append").parquet(folder)


def run(stream, spark, out, chk):
    q = stream.writeStream.format("parquet").option("checkpointLocation", chk).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return [p for p in q.recentProgress if p["stateOperators"]]


def test_each_message_is_answered_once_and_the_state_shrinks(spark):
    folder, out, chk = (scratch_path(spark, n) for n in ("turns", "answers", "chk"))
    days = [[(c, t, 24 * day + t) for c in range(10 * day, 10 * day + 10) for t in range(4)] for day in range(6)]
    for rows in (days[0], days[0], days[2], days[1] + days[2][:8], days[3] + days[3], days[4], days[5], days[0] + days[5]):
        delivered(spark, folder, rows)
    live = S.once(spark.readStream.schema(TURNS).option("maxFilesPerTrigger", 1).parquet(folder), delay="30 hours")
    answers = S.answer_stream(live, B.default_bank(spark), STOCK_LEXICON)
    progress = run(answers, spark, out, chk)
    got = [tuple(r) for r in spark.read.parquet(out).select("conv_id", "turn").collect()]
    assert sorted(got) == sorted((c, t) for rows in days for c, t, _ in rows)
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsRemoved"] for s in state) > 0 and state[-1]["numRowsTotal"] < len(got)
    # the feed goes on from its checkpoint: a known message stays answered, one behind the watermark is dropped
    delivered(spark, folder, days[5][:5] + [(99, 0, 24 * 6), (98, 0, 1)])
    run(answers, spark, out, chk)
    again = [tuple(r) for r in spark.read.parquet(out).select("conv_id", "turn").collect()]
    assert sorted(again) == sorted(got + [(99, 0)])


def test_once_on_a_table(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (None, 0), (None, 0)], "conv_id long, turn long")
    assert S.once(df).count() == 3


LOG = "key long, at long, seconds double"


def logged(spark, folder, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)


def version_rows(spark, path, schema):
    return {r["version"]: r["count"] for r in U.versions(spark, path, schema).groupBy("version").count().collect()}


def test_versions_hold_changed_keys_and_the_latest_wins(spark):
    folder, path, chk = (scratch_path(spark, n) for n in ("log", "table", "chk"))
    batches = [[(k, 1, float(k)) for k in range(100)], [(7, 2, 0.5), (7, 3, 0.25), (200, 1, 9.0)], [(7, 1, 8.0)], [(8, 5, 1.0)]]
    for rows in batches[:3]:
        logged(spark, folder, rows)
    stream = V.response_info(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder), "key", "at")
    U.upsert_available(stream, spark, path, ["key"], 4, chk)
    schema = stream.schema
    assert version_rows(spark, path, schema) == {0: 100, 1: 2, 2: 1}  # rows a batch follow its keys
    want = {k: float(k) for k in range(100)} | {7: 0.25, 200: 9.0}
    def now(p=path, **more):
        return {r["key"]: r["last_seconds"] for r in U.latest(spark, p, schema, ["key"], buckets=4, **more).collect()}
    assert now() == want
    # a replayed batch changes nothing
    one = spark.createDataFrame(U.versions(spark, path, schema).where("version = 1").drop("version", "bucket").collect(), schema)
    U.write_version(one, 1, path, ["key"], 4)
    assert now() == want and version_rows(spark, path, schema) == {0: 100, 1: 2, 2: 1}
    # few keys read their buckets only
    few = U.latest(spark, path, schema, ["key"], spark.createDataFrame([(7,), (200,), (999,)], "key long"), 4)
    assert {r["key"]: r["last_seconds"] for r in few.collect()} == {7: 0.25, 200: 9.0}
    assert "PartitionFilters: [bucket" in few._jdf.queryExecution().executedPlan().toString()
    # compacted, and the stream goes on
    out = U.compact(spark, path, schema, ["key"], scratch_path(spark, "compacted"), 4)
    assert now(out) == want and version_rows(spark, out, schema) == {2: 101}
    logged(spark, folder, batches[3])
    U.upsert_available(stream, spark, out, ["key"], 4, chk)
    assert now(out) == want | {8: 1.0} and max(version_rows(spark, out, schema)) == 3
    assert os.path.isdir(f"{out}/version=3")


def test_a_version_has_a_file_a_bucket(spark):
    path = scratch_path(spark, "table")
    batch = spark.range(2000, numPartitions=20).selectExpr("id AS key", "1L AS at")
    U.write_version(batch, 0, path, ["key"], 4)
    assert sum(f.endswith(".parquet") for _, _, files in os.walk(path) for f in files) == 4
    rows = U.versions(spark, path, batch.schema)
    assert rows.count() == 2000 and rows.where(U.bucket_of(["key"], 4) != rows["bucket"]).isEmpty()


def test_empty_feed(spark):
    folder = scratch_path(spark, "log")
    logged(spark, folder, [])
    stream = V.response_info(spark.readStream.schema(LOG).parquet(folder), "key", "at")
    path = scratch_path(spark, "table")
    U.upsert_available(stream, spark, path, ["key"])
    assert U.latest(spark, path, stream.schema, ["key"]).count() == 0
    assert U.latest(spark, scratch_path(spark, "none"), stream.schema, ["key"]).count() == 0
