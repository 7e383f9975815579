"""File sources and sinks: CSV pairs, split folders, numbered question text,
JSON result documents, prepared (encoded) datasets, metadata and reports.

Writers produce folders (one file per task) and readers read whole folders,
so both scale with the cluster.  Splits are written in one job with
``partitionBy("split")`` and read back with partition pruning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import DEFAULT_QUESTIONS
from ..functions.ranking import bucket_offsets
from ..functions.text import after_first, strip_ws

PAIRS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("input_text", T.StringType(), True),
    T.StructField("target_text", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("intent", T.StringType(), True),
])

# Nulls are written as the marker \N (Hive convention) so that empty strings
# ("" in the file) and nulls survive a round trip; a text that is exactly \N
# reads back as null.
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("flags", T.StringType(), True),
    T.StructField("instruction", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("intent", T.StringType(), True),
    T.StructField("response", T.StringType(), True),
])

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "nullValue": "\\N"}


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``"file"``, ``"folder"`` or None (missing), on whatever file system the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(where):
        return None
    return "folder" if store.getFileStatus(where).isDirectory() else "file"


# --- SRC-1 / SRC-3 / SNK-1: CSV ---------------------------------------------------------


def write_pairs_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ("split",)) -> None:
    """SNK-1: CSV with header, quoted text (embedded newlines and quotes kept);
    one folder per split in a single job."""
    w = df.write.mode("overwrite").options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"})
    cols = [c for c in partition_by if c in df.columns]
    (w.partitionBy(*cols) if cols else w).csv(path)


def read_pairs_csv(spark: SparkSession, path: str, schema: T.StructType = PAIRS_SCHEMA) -> DataFrame:
    """SRC-1: read Q/A pair CSV with an explicit schema (no inference pass).

    ``multiLine`` parsing cannot split a file: right for many files (the writer
    makes one per task).  ``csv_split.read_csv_records`` reads large files in
    parallel and puts malformed records aside.
    """
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def scan_csv_dir(spark: SparkSession, folder: str, schema: T.StructType = PAIRS_SCHEMA) -> DataFrame:
    """SRC-3: every ``*.csv`` file below ``folder`` (all of them, deterministically,
    where the original took the first in listing order)."""
    return (spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true").schema(schema).csv(folder))


# --- SRC-2 / SRC-6 / SNK-2: split folders ----------------------------------------------------


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """SNK-2: Parquet partitioned by split (one job for all splits)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def scan_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """SRC-2 / SRC-6: one named split, read with partition pruning."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


# --- SNK-4 / SRC-4: numbered question text ------------------------------------------------------


def numbered_lines(df: DataFrame, text_col: str, pos_col: str) -> DataFrame:
    """SNK-4 content: ``"{pos}. {text}"`` lines (``value``), with ``pos`` kept."""
    return df.select(F.col(pos_col).alias("pos"),
                     F.concat(F.col(pos_col).cast("string"), F.lit(". "), F.col(text_col)).alias("value"))


def write_numbered_text(lines: DataFrame, path: str) -> None:
    """Write numbered lines as text, in order of ``pos`` over the files of the
    folder (range partitioned and sorted, so no task holds all lines)."""
    lines.repartitionByRange("pos").sortWithinPartitions("pos").select("value").write.mode("overwrite").text(path)


def parse_numbered_questions(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC-4: strip every line; if it contains ``". "`` keep what follows the
    first one, else keep the line (blank lines give '')."""
    stripped = strip_ws(F.col(value_col))
    return lines.withColumn("question", after_first(stripped, ". "))


def read_numbered_questions(spark: SparkSession, path: str) -> DataFrame:
    return parse_numbered_questions(spark.read.text(path))


# --- SRC-7: source or default ----------------------------------------------------------------------


def source_or_default(source: DataFrame, defaults: DataFrame) -> DataFrame:
    """SRC-7: the source rows, or the default rows when the source is empty.

    Decided inside the plan: the defaults are kept only when a one-row probe
    of the source finds nothing (left-anti join against ``source.limit(1)``).
    """
    probe = source.limit(1).select(F.lit(1).alias("_any"))
    fallback = defaults.withColumn("_any", F.lit(1)).join(probe, "_any", "left_anti").drop("_any")
    return source.unionByName(fallback)


def first_non_empty(candidates: Sequence[DataFrame | None], defaults: DataFrame) -> DataFrame:
    """SRC-7 chain: the first candidate with rows, else ``defaults``.

    ``None`` stands for a missing source (decided when the plan is built);
    emptiness is decided inside the plan, one anti-join probe per link.
    """
    out = defaults
    for cand in reversed([c for c in candidates if c is not None]):
        out = source_or_default(cand, out)
    return out


def default_labels(spark: SparkSession) -> DataFrame:
    """Fixed category and intent lists as ``(field, value, position)``."""
    from ..functions.constants import DEFAULT_CATEGORIES, DEFAULT_INTENTS

    rows = [("category", v, i + 1) for i, v in enumerate(DEFAULT_CATEGORIES)]
    rows += [("intent", v, i + 1) for i, v in enumerate(DEFAULT_INTENTS)]
    return spark.createDataFrame(rows, "field string, value string, position bigint")


def default_questions(spark: SparkSession, col: str = "question") -> DataFrame:
    rows = [(i + 1, q) for i, q in enumerate(DEFAULT_QUESTIONS)]
    return spark.createDataFrame(rows, f"pos int, {col} string")


# --- SNK-6 / SRC-5: result documents ----------------------------------------------------------------

# One chunk of a run's responses; a run has as many chunks as it needs.
RESULT_DOC_SCHEMA = ("run string, first_pos bigint, "
                     "responses array<struct<query:string, response:string, response_time:double>>")

# The three published result documents, by the shape of their entries.
VALIDATION_DOC_SCHEMA = (
    "template_results array<struct<query:string, response:string, response_time:double>>, "
    "model_results array<struct<query:string, response:string, response_time:double>>, "
    "avg_template_time double, avg_model_time double, speedup_factor double")
EVALUATION_DOC_SCHEMA = (
    "template_avg_time double, model_avg_time double, speedup double, "
    "responses array<struct<query:string, template_response:string, model_response:string, "
    "template_time:double, model_time:double>>")
INFERENCE_DOC_SCHEMA = (
    "results array<struct<input:string, target:string, generated:string, inference_time:double>>, "
    "avg_inference_time double")


def _placed(log: DataFrame, run_col: str, order_col: str, chunk: int) -> DataFrame:
    """``_p``: the 0-based place of a row in its run, in order of a number or a hash text.

    Places come from counts of (run, order bucket) and a rank within each, so a run of any length is
    placed by many tasks.  Texts are bucketed by a prefix, so they must be spread, as hashes are.
    """
    text_order = dict(log.dtypes)[order_col] == "string"  # buckets must follow the order
    bucketed = log.withColumn("_b", F.substring(order_col, 1, 2) if text_order else F.floor(F.col(order_col) / F.lit(chunk)))
    offsets = bucket_offsets(bucketed, "_b", [run_col]).select(run_col, "_b", "_start")
    rank = F.row_number().over(Window.partitionBy(run_col, "_b").orderBy(order_col)) - 1
    return (bucketed.withColumn("_p", rank).join(offsets, [run_col, "_b"])
            .withColumn("_p", F.col("_start") + F.col("_p")))


def _entries(*fields: str) -> Column:
    """The rows of a chunk in order, as an array of structs."""
    found = F.array_sort(F.collect_list(F.struct("_p", *fields)))
    return F.transform(found, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def result_documents(log: DataFrame, run_col: str = "run", order_col: str = "pos", chunk: int = 1000) -> DataFrame:
    """SNK-6 content: every response of every run, in ``order_col`` order, as
    nested documents of at most ``chunk`` responses (``first_pos`` 0-based)."""
    placed = _placed(log, run_col, order_col, chunk)
    return placed.groupBy(F.col(run_col).alias("run"), (F.floor(F.col("_p") / chunk) * chunk).cast("bigint").alias("first_pos")).agg(
        _entries("query", "response", "response_time").alias("responses"))


def published_documents(log: DataFrame, kind: str, order_col: str = "pos", chunk: int = 1000) -> DataFrame:
    """SNK-6 in the three published shapes, as documents of at most ``chunk`` entries a list.

    ``kind``: ``validation`` from rows (run = template or model, query, response, response_time),
    ``evaluation`` from rows (query, template_response, model_response, template_time, model_time),
    ``inference`` from rows (input, target, generated, inference_time).  The means and the speedup
    (0 if the template mean is 0) are those of the whole log in every document.
    """
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.when(b.isNotNull() & a.isNotNull(), F.lit(0.0)))
    one = lambda c: log.agg(c.alias("v")).scalar()
    part = F.floor(F.col("_p") / chunk).alias("_part")
    if kind == "validation":
        placed = _placed(log.where(F.col("run").isin("template", "model")), "run", order_col, chunk)
        lists = placed.groupBy("run", part).agg(_entries("query", "response", "response_time").alias("rs"))
        of = lambda run: F.coalesce(F.first(F.when(F.col("run") == run, F.col("rs")), True), F.array().cast(lists.schema["rs"].dataType))
        docs = lists.groupBy("_part").agg(of("template").alias("template_results"), of("model").alias("model_results"))
        mean = lambda run: one(F.avg(F.when(F.col("run") == run, F.col("response_time"))))
        docs = docs.withColumn("avg_template_time", mean("template")).withColumn("avg_model_time", mean("model"))
        return docs.withColumn("speedup_factor", ratio(F.col("avg_model_time"), F.col("avg_template_time"))).drop("_part")
    placed = _placed(log.withColumn("_run", F.lit(kind)), "_run", order_col, chunk).groupBy(part)
    if kind == "evaluation":
        docs = placed.agg(_entries("query", "template_response", "model_response", "template_time", "model_time").alias("responses"))
        docs = docs.withColumn("template_avg_time", one(F.avg("template_time"))).withColumn("model_avg_time", one(F.avg("model_time")))
        return docs.withColumn("speedup", ratio(F.col("model_avg_time"), F.col("template_avg_time"))).drop("_part")
    if kind != "inference":
        raise ValueError(f"unknown kind {kind!r}")
    docs = placed.agg(_entries("input", "target", "generated", "inference_time").alias("results"))
    return docs.withColumn("avg_inference_time", one(F.avg("inference_time"))).drop("_part")


def write_result_documents(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").json(path)


def read_response_log(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SRC-5: many result documents -> one flat response log
    ``(run, source_file, pos, query, response, response_time)``."""
    docs = (spark.read.schema(RESULT_DOC_SCHEMA).option("multiLine", str(multi_line).lower()).json(path)
            .withColumn("source_file", F.input_file_name()))
    return docs.select("run", "source_file", "first_pos", F.posexplode("responses").alias("pos", "r")).select(
        "run", "source_file", (F.col("first_pos") + F.col("pos") + 1).alias("pos"), "r.query", "r.response", "r.response_time")


def read_published_results(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """SRC-5: published result documents (one indented JSON object a file, or
    without ``multi_line`` one a line, as ``published_documents`` are written) as flat rows ``(source_file, run, pos, query, response, response_time)``.

    ``kind``: ``validation`` (template and model results), ``evaluation`` (both
    paths of each query in one entry) or ``inference`` (generated texts).
    """
    schema = {"validation": VALIDATION_DOC_SCHEMA, "evaluation": EVALUATION_DOC_SCHEMA, "inference": INFERENCE_DOC_SCHEMA}[kind]
    docs = spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path).withColumn("source_file", F.input_file_name())

    def rows(array: str, run: str, query: str, response: str, seconds: str) -> DataFrame:
        return docs.select("source_file", F.lit(run).alias("run"), F.posexplode(array).alias("pos", "r")).select(
            "source_file", "run", (F.col("pos") + 1).alias("pos"), F.col(f"r.{query}").alias("query"),
            F.col(f"r.{response}").alias("response"), F.col(f"r.{seconds}").alias("response_time"))

    if kind == "validation":
        return rows("template_results", "template", "query", "response", "response_time").unionByName(
            rows("model_results", "model", "query", "response", "response_time"))
    if kind == "evaluation":
        return rows("responses", "template", "query", "template_response", "template_time").unionByName(
            rows("responses", "model", "query", "model_response", "model_time"))
    return rows("results", "model", "input", "generated", "inference_time")


# --- SNK-3 / SNK-5: metadata and report -----------------------------------------------------------


def write_json_rows(df: DataFrame, path: str) -> None:
    """SNK-3: a (small) summary table as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def report_lines(report: DataFrame) -> DataFrame:
    """SNK-5 content: ``section: name: value`` text lines."""
    return report.select("section", "ord", F.concat_ws(": ", "section", "name", "value").alias("value"))


def write_report(report: DataFrame, path: str) -> None:
    report_lines(report).orderBy("section", "ord").select("value").coalesce(1).write.mode("overwrite").text(path)


# --- SRC-5: configuration documents ----------------------------------------------------------------


def config_document(spark: SparkSession, settings: dict) -> DataFrame:
    """A flat configuration as a one-row DataFrame (values keep their types)."""
    return spark.createDataFrame([tuple(settings.values())], list(settings.keys()))


def write_config(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").json(path)


def read_config(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read configuration document(s); indented single documents need ``multi_line``."""
    return spark.read.option("multiLine", str(multi_line).lower()).json(path)
