"""Chat formatting by event-sourced reconstruction.

A log holds one event per row: (conv_id, message, seq, op, arg, payload).  Rows of one message are
partitioned together and sorted by ``seq`` (at-least-once copies of an event, equal in conversation,
message and seq, count once), then folded as they stream by:

* ``start``       opens the message; payload is the role
* ``delta``       appends payload
* ``edit``        replaces everything from code point ``arg`` on by payload
* ``regenerate``  drops the text so far

So state is one message, and a conversation of any length spreads over tasks.  ``render`` turns each
message into one segment of the conversation's formatted text; concatenated by ``position`` they
are the conversation.  Control strings inside texts are escaped reversibly, so ``parse`` reads back
roles and texts, and the loss mask (start, length in code points of the escaped text) covers
assistant texts only.

Edge cases: null text and role count as empty; a null conv_id or turn is a value of its own (nulls
first); equal rows are kept each; a conversation without messages does not appear; empty tables
give empty results.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import tasks

EVENTS = "conv_id long, turn long, message string, seq long, op string, arg long, payload string"
HEAD, HEAD_END, TAIL = "### ", ":\n", "\n</turn>\n"
_OUT = {"\\": "\\\\", "#": "\\h", "</turn>": "\\l/turn>", ":": "\\c"}
_BACK = {"\\\\": "\\", "\\h": "#", "\\l": "<", "\\c": ":"}
_ESCAPED, _CONTROL, _ROLE = re.compile(r"\\[\\hlc]"), re.compile(r"\\|#|</turn>"), re.compile(r"\\|#|</turn>|:")


def escape(text: str, role: bool = False) -> str:
    """No ``#`` and no ``</turn>`` is left (in a role, no ``:`` either)."""
    return (_ROLE if role else _CONTROL).sub(lambda m: _OUT[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[0]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(segment, start and length of the loss mask in it)."""
    head, body = HEAD + escape(role, True) + HEAD_END, escape(text)
    return head + body + TAIL, len(head), len(body) if role == "assistant" else 0


def parse(segment: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of formatted text."""
    out = []
    while segment:
        if not segment.startswith(HEAD):
            raise ValueError("no turn starts here")
        a, b = segment.index(HEAD_END), segment.index(TAIL)
        out.append((unescape(segment[len(HEAD): a]), unescape(segment[a + len(HEAD_END): b])))
        segment = segment[b + len(TAIL):]
    return out


def fold(events) -> tuple[str, str]:
    """(role, text) of one message from its (seq, op, arg, payload) in order."""
    role, parts, last = "", [], None
    for seq, op, arg, payload in events:
        if seq == last:
            continue
        last = seq
        if op == "start":
            role = payload or ""
        elif op == "delta":
            parts.append(payload or "")
        elif op == "regenerate":
            parts = []
        elif op == "edit":
            parts = ["".join(parts)[:arg], payload or ""]
        else:
            raise ValueError(f"unknown event {op!r}")
    return role, "".join(parts)


def _rows(batches, columns):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns))


def _batches(rows, schema: pa.Schema, most: int = 4 << 20):
    """Rows as Arrow batches of about ``most`` characters at most."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, str))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text): the final messages of a log of events."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("message", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        def folded():
            rows = _rows(batches, ("conv_id", "turn", "message", "seq", "op", "arg", "payload"))
            for key, own in groupby(rows, key=lambda r: r[:3]):
                yield (*key, *fold(r[3:] for r in own))
        yield from _batches(folded(), schema)

    n = tasks(events.sparkSession)
    return (events.repartition(n, "conv_id", "turn", "message").sortWithinPartitions("conv_id", "turn", "message", "seq", "op")
            .mapInArrow(run, "conv_id long, turn long, message string, role string, text string"))


def format_messages(messages: DataFrame) -> DataFrame:
    """Adds segment, loss_start and loss_length; position in a conversation is (turn, message)."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("message", pa.string()), ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_length", pa.int64())])

    def run(batches):
        rows = _rows(batches, ("conv_id", "turn", "message", "role", "text"))
        yield from _batches((r[:3] + render(r[3] or "", r[4] or "") for r in rows), schema)

    return messages.select("conv_id", "turn", "message", "role", "text").mapInArrow(run, "conv_id long, turn long, message string, segment string, loss_start long, loss_length long")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments in order: counts and digests.

    A digest of a whole conversation needs its text in order, so a conversation streams through one
    task; that task holds one segment and two running hashes, whatever the length.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        def read():
            rows = _rows(batches, ("conv_id", "segment", "loss_start", "loss_length"))
            for conv, own in groupby(rows, key=lambda r: r[0]):
                turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, segment, start, length in own:
                    for role, text in parse(segment):
                        turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                        n += 1
                    masked = unescape(segment[start: start + length])
                    loss.update(masked.encode("utf-8", "surrogatepass"))
                    chars, size = chars + len(masked), size + len(segment)
                yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), size
        yield from _batches(read(), schema)

    n = tasks(formatted.sparkSession)
    return (formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "message")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def as_events(turns: DataFrame, chunk: int = 400) -> DataFrame:
    """A streamed log whose fold gives back (conv_id, turn, role, text) rows.

    Texts arrive as deltas of ``chunk`` code points.  Every fifth assistant message (by a hash) has
    a first draft that is regenerated, and every seventh message has its end mended by an edit.
    """
    t, r = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    copy = Window.partitionBy("conv_id", "turn", "_r", "_h").orderBy(F.lit(1))
    rows = (turns.select("conv_id", "turn", r.alias("_r"), t.alias("_t")).withColumn("_h", F.md5("_t"))
            .withColumn("_copy", F.row_number().over(copy))
            .withColumn("message", F.concat_ws("/", "_r", "_h", F.lpad(F.col("_copy").cast("string"), 9, "0"))))
    pick = F.xxhash64("conv_id", "turn", "_h")
    event = lambda seq, op, payload, arg=F.lit(None): F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(op).alias("op"), arg.cast("long").alias("arg"), payload.alias("payload"))
    n = F.length("_t")
    cuts = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(n - 1, F.lit(0)) / chunk).cast("int")),
                       lambda i: F.struct((i + 10).cast("long").alias("seq"), F.lit("delta").alias("op"), F.lit(None).cast("long").alias("arg"), F.substring(F.col("_t"), i * chunk + 1, F.lit(chunk)).alias("payload")))
    none = F.filter(F.array(event(0, "", F.lit(""))), lambda x: F.lit(False))
    draft = F.when((F.col("_r") == "assistant") & (F.pmod(pick, F.lit(5)) == 0), F.array(event(1, "delta", F.lit("draft ")), event(2, "delta", F.substring("_t", 1, 40)), event(3, "regenerate", F.lit(None).cast("string")))).otherwise(none)
    edit = F.when(F.pmod(pick, F.lit(7)) == 0, F.array(
        event(1 << 40, "delta", F.lit("...")), event((1 << 40) + 1, "edit", F.substring(F.col("_t"), F.greatest(n - 9, F.lit(1)), F.lit(10)), F.greatest(n - 10, F.lit(0))))).otherwise(none)
    return rows.select("conv_id", "turn", "message", F.explode(F.concat(F.array(event(0, "start", F.col("_r"))), draft, cuts, edit)).alias("e")).select("conv_id", "turn", "message", "e.*")
