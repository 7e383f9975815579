"""CSV with quoted line breaks, read by many tasks a file.

Spark splits a plain text file into blocks, but a block may begin inside a quoted field.  Whether it
does follows from the number of quotes before it: inside a field after an odd number, and doubled quotes
do not change that.  So

1. each block reports the parity of its quotes (one aggregation over the physical lines),
2. a prefix over the blocks of a file gives the state each block begins with,
3. each block is streamed once and its lines are put together to records; what a block holds of a record that
   began before it, or goes on behind it, is a fragment,
4. fragments, at most two a block, are put together by the block in which their record began.

Records are then parsed one by one, natively, in permissive mode: those that do not fit the schema go
to quarantine with their file, place and reason, and all others are read (see :class:`Quarantined`).

A record ends at ``\\n`` or ``\\r\\n``; an unclosed quote runs to the end of its file and is one damaged
record there.  Blank lines between records are skipped.  Both passes must see the same blocks: a block that
the first did not see (say, because ``spark.sql.files.maxPartitionBytes`` was changed in between) is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

PARSE_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\\N", "mode": "PERMISSIVE",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CORRUPT = "_corrupt_record"
MOST_BLOCKS = 4_000_000  # 9 bytes each are sent to every task; 100 TB in blocks of 128 MB are 800,000


@dataclass(frozen=True)
class Quarantined:
    """``rows`` of the schema that was asked for, and ``damaged``: (file, place, reason, record).

    ``place`` is the byte offset of the block in which the record began.
    """

    rows: DataFrame
    damaged: DataFrame

    def counts(self) -> DataFrame:
        """(file, reason, records) of what is in quarantine."""
        return self.damaged.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("records"))


def _lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Physical lines (without ``\\n``) with their file and block."""
    text = spark.read.options(**options).text(path, lineSep="\n")
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def block_states(lines: DataFrame) -> DataFrame:
    """(file, block, open): whether a block begins inside a quoted field."""
    parity = lines.groupBy("file", "block").agg((F.sum(_quotes("value")) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row a block: a file has its size / 128 MB of them
    return parity.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"))


SCHEMA = "file string, block long, started long, whole boolean, first boolean, record string"
ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("started", pa.int64()), ("whole", pa.bool_()), ("first", pa.bool_()), ("record", pa.string())])


def _records_of_blocks(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Records and fragments: ``whole`` ones, and parts of those that cross an edge of their block.

    ``started`` is the block in which a record began, null for a part that began before this block; ``first``
    marks the first record of a file.
    """
    key = F.xxhash64("file", "block").alias("_k")
    held = F.broadcast(states.select(key, "open"))  # its size was checked
    with_state = lines.withColumn("_k", key).join(held, "_k", "left").select("file", "block", "value", "open")

    def run(batches):
        at, opened, began, leads, parts, out = None, False, False, False, [], []

        def finish(closed):
            file, block = at
            out.append((file, block, block if began else None, closed and began, leads, "\n".join(parts)))
            parts.clear()

        def flush():
            rows = list(zip(*out)) or [[]] * len(ARROW)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, ARROW)], schema=ARROW)

        for b in batches:
            for file, block, value, open_ in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (file, block) != at:
                    if parts:
                        finish(False)
                    if open_ is None:
                        raise ValueError("blocks changed between the two passes over the files")
                    at, opened, began, leads = (file, block), open_, not open_, block == 0
                opened ^= value.count('"') % 2 == 1
                parts.append(value)
                if not opened:
                    finish(True)
                    began, leads = True, False
            yield flush()
        if parts:
            finish(False)
        yield flush()

    return with_state.mapInArrow(run, SCHEMA)


def _joined_fragments(parts: DataFrame) -> DataFrame:
    """The records that cross blocks, from their fragments in order.

    Which record a fragment belongs to is found without texts, from at most two fragments a block.
    """
    heads = parts.select("file", "block", "started", F.col("started").isNotNull().alias("tail"))
    before = Window.partitionBy("file").orderBy("block", "tail").rowsBetween(Window.unboundedPreceding, 0)
    heads = heads.select("file", "block", "tail", F.max("started").over(before).alias("head"))
    named = parts.withColumn("tail", F.col("started").isNotNull()).join(heads, ["file", "block", "tail"])
    inside = F.transform(F.array_sort(F.collect_list(F.struct("block", "tail", "record"))), lambda x: x["record"])
    # a record has one fragment for each block it touches
    return named.groupBy("file", F.col("head").alias("started")).agg(F.max("first").alias("first"), F.array_join(inside, "\n").alias("record"))


def records(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """(file, started, first, record): every record of the files as text, header lines included.

    ``options`` are those of the text reader (``pathGlobFilter``, ``recursiveFileLookup``).
    """
    lines = _lines(spark, path, **options)
    states = materialize(block_states(lines), "csv-blocks")
    if states.count() > MOST_BLOCKS:
        raise ValueError(f"more than {MOST_BLOCKS} blocks: set spark.sql.files.maxPartitionBytes higher")
    parts = materialize(_records_of_blocks(lines, states), "csv-records")
    whole = parts.where("whole").select("file", "started", "first", "record")
    return whole.unionByName(_joined_fragments(parts.where("not whole")))


def read_csv_records(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, **options: str) -> Quarantined:
    """SRC-1 for files of any size: the rows of ``schema`` and the records that do not fit it.

    With ``header`` the first record of each file is left out; columns are taken by their place.
    """
    found = records(spark, path, **options).withColumn("record", F.regexp_replace("record", "\r$", ""))
    found = found.where("record <> ''" + (" and not first" if header else ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", {CORRUPT} string"
    rows = found.withColumn("_row", F.from_csv("record", ddl, {**PARSE_OPTIONS, "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull() | (_quotes("record") % 2 == 1)
    return Quarantined(rows.where(~bad).select(*[F.col(f"_row.`{f.name}`") for f in schema.fields]),
                       rows.where(bad).select("file", F.col("started").alias("place"), _reason(len(schema.fields)).alias("reason"), "record"))


def _reason(columns: int) -> Column:
    """Why a record did not fit: an unclosed quote, another number of fields, or a value of another type."""
    bare = F.regexp_replace("record", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (F.when(bare.contains('"'), F.lit("unclosed quote")).when(fields < columns, F.lit("too few fields"))
            .when(fields > columns, F.lit("too many fields")).otherwise(F.lit("value of another type")))


def read_json_records(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False) -> Quarantined:
    """SRC-5: JSON documents (one a line, or with ``multi_line`` one a file) and those that are none.

    A document that is no JSON, or has a value of another type, goes to quarantine.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "")
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("place"), "value",
                       F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_row"))
    bad = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull()
    reason = F.when(F.try_parse_json("value").isNull(), F.lit("no JSON")).otherwise(F.lit("value of another type"))
    return Quarantined(rows.where(~bad).select(*[F.col(f"_row.`{f.name}`") for f in schema.fields]),
                       rows.where(bad).select("file", "place", reason.alias("reason"), F.col("value").alias("record")))


def quarantine_report(found: Quarantined, section: str = "quarantine") -> DataFrame:
    """Lines of the profile report: how many records were read and how many, by reason, were not."""
    read = found.rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("name"), "n")
    bad = found.damaged.groupBy(F.col("reason").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    both = read.unionByName(bad)
    return both.select(F.lit(section).alias("section"), "name", F.col("n").cast("string").alias("value"),
                       F.row_number().over(Window.partitionBy(F.lit(section)).orderBy(F.col("name") != "read", "name")).alias("ord"))
