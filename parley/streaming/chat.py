"""Chat as a stream: answer every incoming message once, keep a per-conversation
history, clear it on request, and report the last response time.

* ``once``: a message that is delivered twice, or late, goes on once; what is remembered
  of a message is its key, until the watermark has passed it.
* ``answer_stream``: the batch answering plan applied to a streaming frame; the
  bank is static, so this is a stream-static join.  Pass a written bank
  (restart the query to pick up a new one).  Template choice is a hash of the
  question, so a replayed micro-batch gives the same answers.
* ``chat_history``: ``groupBy(conv_id).applyInPandasWithState``; the state of a
  conversation is one counter, no texts.  It emits the position of each
  recorded turn since the last clear **in order of arrival** (turns of one
  micro-batch are ordered by turn).
* ``chat_history_batch``: positions in turn order over a table, whatever the
  order of arrival, with two-phase running counts instead of one window per
  conversation.  Run it over the turns that ``answer_stream`` has written when
  turns may arrive late.

Checkpoints go below the shared scratch root (``spark.checkpoint.dir``), a
new folder per run.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.constants import STOCK_LEXICON
from ..functions.lexicon import Lexicon
from ..functions.ranking import running_count
from ..operators.respond import answer_questions
from ..session import scratch_path
from ..sources.files import path_kind

HISTORY_OUT = T.StructType([
    T.StructField("conv_id", T.LongType(), True),
    T.StructField("turn", T.LongType(), True),
    T.StructField("history_pos", T.LongType(), True),
])
HISTORY_STATE = T.StructType([T.StructField("since_clear", T.LongType(), True)])


def file_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Rows arriving as Parquet files: those in the table folder ``folder/glob``
    if there is one, else the files of ``folder`` whose names match ``glob``."""
    path = f"{folder.rstrip('/')}/{glob}"
    if schema is None:
        schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not set("*?[{") & set(glob) and path_kind(spark, path) == "folder":
        return reader.parquet(path)
    return reader.option("pathGlobFilter", glob).parquet(folder)


def conversation_stream(spark: SparkSession, folder: str, glob: str = "conversations.parquet",
                        schema: T.StructType | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Chat turns arriving as Parquet files."""
    return file_stream(spark, folder, glob, schema, files_per_trigger)


def once(turns: DataFrame, keys: Sequence[str] = ("conv_id", "turn"), event_time: str = "sent_at",
         delay: str = "1 hour") -> DataFrame:
    """STR-1, answered once: of the messages with equal ``keys`` the first to arrive.

    ``event_time`` says when a message was sent and ``delay`` how late it, or a copy of it, may arrive.  Keys
    are dropped from the state when the watermark has passed their time, and whatever arrives
    later than that is dropped as late, so nothing is answered twice and the state does not grow.  A message
    without a time is never late; a table (no stream) is de-duplicated by its keys.
    """
    if not turns.isStreaming:
        return turns.dropDuplicates(list(keys))
    return turns.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def answer_stream(turns: DataFrame, bank: DataFrame, lexicon: Lexicon = STOCK_LEXICON,
                  text_col: str = "text", role_col: str = "role") -> DataFrame:
    """STR-1: answer user messages; system messages pass through as clear
    events (``is_clear``); other roles are dropped."""
    msgs = turns.where(F.col(role_col).isin("user", "system"))
    answered = answer_questions(msgs, bank, lexicon, text_col)
    clear = F.col(role_col) == "system"
    return (answered.withColumn("is_clear", clear)
            .withColumn("recorded", ~clear & (F.col("route") != "guard"))
            .withColumn("response", F.when(~clear, F.col("response")))
            .withColumn("message", F.col(text_col)))


def message_flags(turns: DataFrame, text_col: str = "text", role_col: str = "role") -> DataFrame:
    """Which messages clear the history and which are recorded, as ``answer_stream`` marks them, without answering."""
    clear, text = F.col(role_col) == "system", F.col(text_col)
    return (turns.where(F.col(role_col).isin("user", "system")).withColumn("is_clear", clear)
            .withColumn("recorded", ~clear & text.isNotNull() & (text != "")))


def _history_fn(idle_timeout_ms: int | None):
    def fn(key, batches, state):
        if state.hasTimedOut:
            # conversation idle for longer than the timeout: forget its counter
            state.remove()
            yield pd.DataFrame([], columns=[f.name for f in HISTORY_OUT.fields])
            return
        since = state.get[0] if state.exists else 0
        turns = pd.concat(list(batches), ignore_index=True).sort_values("turn", kind="stable")
        # positions count recorded turns since the last clear, carried over from earlier batches
        segment = turns["is_clear"].cumsum()
        pos = turns["recorded"].astype("int64").groupby(segment).cumsum()
        pos = pos + (segment == 0) * since
        state.update((int(pos.iloc[-1]),))
        if idle_timeout_ms:
            state.setTimeoutDuration(int(idle_timeout_ms))
        kept = turns["recorded"]
        yield pd.DataFrame({"conv_id": None if key[0] is None else int(key[0]), "turn": turns["turn"][kept], "history_pos": pos[kept]})

    return fn


def chat_history(answered: DataFrame, key: str = "conv_id", idle_timeout_ms: int | None = None) -> DataFrame:
    """STR-2 + STR-3 on a stream: ``(conv_id, turn, history_pos)`` of each
    recorded message, counted in order of arrival and reset by clear events.
    Only narrow rows reach the state; see ``with_texts`` for the messages.

    ``idle_timeout_ms`` drops the counter of a conversation that received
    nothing for that long (processing time; for continuously running queries
    -- a run-once ``availableNow`` query keeps scheduling timeout batches and
    never finishes).
    """
    cols = answered.select(F.col(key).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "is_clear", "recorded")
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout_ms else GroupStateTimeout.NoTimeout
    return cols.groupBy("conv_id").applyInPandasWithState(
        _history_fn(idle_timeout_ms), HISTORY_OUT, HISTORY_STATE, "append", timeout)


def with_texts(positions: DataFrame, answered: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """History rows: positions joined with the recorded turns' texts."""
    texts = answered.where(F.col("recorded")).select(F.col(key).cast("long").alias("_c"), F.col(order).cast("long").alias("_t"), "message", "response")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t"))
    return positions.join(texts, same).select("conv_id", "turn", "history_pos", "message", "response")


def with_saved_texts(positions: DataFrame, saved: DataFrame) -> DataFrame:
    """History rows from recorded turns that were written bucketed by ``(conv_id, turn)`` (see ``sources.bucketed``).

    Positions go to the buckets; the texts are read where they lie.  Rows without a conversation are one of
    their own.
    """
    cols = ["conv_id", "turn", "history_pos", "message", "response"]
    texts, alone = saved.select("conv_id", "turn", "message", "response"), F.col("conv_id").isNull()
    keyed = positions.where(~alone).join(texts.where(~alone), ["conv_id", "turn"]).select(*cols)
    rest = positions.where(alone).join(texts.where(alone).drop("conv_id"), "turn").select(*cols)
    return keyed.unionByName(rest)


def chat_history_batch(answered: DataFrame, key: str = "conv_id", order: str = "turn", flags: DataFrame | None = None) -> DataFrame:
    """STR-2 + STR-3 over a table: the history in turn order.

    Both running counts run on a narrow (key, turn, flags) table; the texts
    are joined back once, so they are shuffled once rather than per count.
    With ``flags`` (see ``message_flags``) the counts do not wait for the answers.
    Rows with a null key are one conversation of their own.
    """
    return with_texts(history_positions(answered if flags is None else flags, key, order), answered, key, order)


def history_positions(flags: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``(conv_id, turn, history_pos)`` of each recorded turn of a table, in turn order."""
    narrow = flags.select(key, order, "is_clear", "recorded")
    seg = running_count(narrow, [key], order, F.col("is_clear"), "_seg")
    pos = running_count(seg, [key, "_seg"], order, F.col("recorded"), "history_pos").where(F.col("recorded"))
    return pos.select(F.col(key).cast("long").alias("conv_id"), F.col(order).cast("long").alias("turn"), "history_pos")


def run_available(stream: DataFrame, spark: SparkSession, name: str, fmt: str = "parquet",
                  output_mode: str = "append") -> DataFrame:
    """Run a streaming plan over everything available now into a fresh folder
    below the scratch root and return the written table."""
    out = scratch_path(spark, f"{name}-out")
    chk = scratch_path(spark, f"{name}-chk")
    q = (stream.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", chk)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.format(fmt).load(out)


def response_info_stream(log: DataFrame, key: str, order: str, seconds: str) -> DataFrame:
    """STR-4 on a stream: latest seconds per key as text (stateful aggregation,
    partial-aggregated per micro-batch).  Run it in update mode, see ``streaming.upsert``."""
    from ..operators.evaluate import response_info
    return response_info(log, key, order, seconds)


__all__: Sequence[str] = [
    "file_stream", "conversation_stream", "once", "answer_stream", "chat_history", "chat_history_batch", "history_positions",
    "with_texts", "with_saved_texts",
    "run_available", "response_info_stream",
]
