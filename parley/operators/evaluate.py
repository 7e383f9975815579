"""Evaluation summaries: response-time means and speedups, and accuracy.

Seconds are an input column (the original times calls with a wall clock; a
Spark job cannot time single rows meaningfully).  All summaries are global
aggregations with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import RESPONSE_INFO_FORMAT


def ratio_or_zero(num: F.Column, den: F.Column) -> F.Column:
    """num / den, 0 when den is not positive (and null when either is null)."""
    return F.when(den > 0, num / den).otherwise(F.when(den.isNotNull() & num.isNotNull(), F.lit(0.0)))


def latency_summary(log: DataFrame, path_col: str = "path", seconds_col: str = "seconds",
                    template_path: str = "template", model_path: str = "model") -> DataFrame:
    """AGG-9: mean seconds of the template path and of the model path, and
    speedup = model / template (0 when the template mean is 0)."""
    p, s = F.col(path_col), F.col(seconds_col)
    out = log.agg(
        F.avg(F.when(p == template_path, s)).alias("avg_template_time"),
        F.avg(F.when(p == model_path, s)).alias("avg_model_time"),
        F.count(F.when(p == template_path, 1)).cast("bigint").alias("template_rows"),
        F.count(F.when(p == model_path, 1)).cast("bigint").alias("model_rows"),
    )
    return out.withColumn("speedup_factor",
                          ratio_or_zero(F.col("avg_model_time"), F.col("avg_template_time")))


def latency_by_path(log: DataFrame, path_col: str = "path", seconds_col: str = "seconds") -> DataFrame:
    """Mean seconds per actual route (template hits separated from fall-through)."""
    return log.groupBy(path_col).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                     F.avg(seconds_col).alias("avg_seconds"))


def run_speedup(log: DataFrame, run_col: str, before: str, after: str,
                seconds_col: str = "seconds") -> DataFrame:
    """AGG-10: mean seconds of run ``before`` divided by that of run ``after``
    (0-guarded), as one row."""
    r, s = F.col(run_col), F.col(seconds_col)
    means = log.where(r.isin(before, after)).agg(
        F.avg(F.when(r == before, s)).alias("avg_before"),
        F.avg(F.when(r == after, s)).alias("avg_after"))
    return (means.withColumn("run_before", F.lit(before)).withColumn("run_after", F.lit(after))
            .withColumn("speedup", ratio_or_zero(F.col("avg_before"), F.col("avg_after"))))


def predictions(df: DataFrame, logits_col: str = "logits", out: str = "prediction") -> DataFrame:
    """argmax of the logits array, 0-based; the first maximum wins."""
    l = F.col(logits_col)
    return df.withColumn(out, (F.array_position(l, F.array_max(l)) - 1).cast("int"))


def accuracy(df: DataFrame, logits_col: str = "logits", label_col: str = "label") -> DataFrame:
    """AGG-11: mean(prediction == label) over rows, with the row count."""
    pred = predictions(df, logits_col, "_pred")
    return pred.agg(
        F.avg((F.col("_pred") == F.col(label_col)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).cast("bigint").alias("rows"))


def response_info(log: DataFrame, key_col: str, order_col: str, seconds_col: str = "seconds") -> DataFrame:
    """STR-4 (batch form): per key the text ``Response time: x.xx seconds`` of
    its last response in ``order_col`` order."""
    last = log.groupBy(key_col).agg(F.max_by(F.col(seconds_col), F.col(order_col)).alias("last_seconds"))
    return last.withColumn("info", F.format_string(RESPONSE_INFO_FORMAT, F.col("last_seconds")))


def metric_callback(df: DataFrame, metric, prediction_col: str = "prediction", label_col: str = "label",
                    name: str = "metric") -> DataFrame:
    """UDF-3: a user metric over (predictions, references).

    ``metric(prediction, label)`` returns an aggregate Column, so the metric
    runs as a native aggregation (map-side partial) instead of a Python
    function over all rows gathered in one task.
    """
    return df.agg(metric(F.col(prediction_col), F.col(label_col)).alias(name),
                  F.count(F.lit(1)).cast("bigint").alias("rows"))


def batch_metric(df: DataFrame, fn: Callable[[pd.Series, pd.Series], dict[str, float]], names: Sequence[str],
                 prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """UDF-3 for a user function of (predictions, references): ``fn`` maps a
    batch to sums by name (say, hits and rows), and the batches' sums are
    added; ratios are left to the caller, so any batch size gives one result."""
    def run(batches):
        for pdf in batches:
            found = fn(pdf[prediction_col], pdf[label_col])
            yield pd.DataFrame({n: [float(found[n])] for n in names})

    parts = df.select(prediction_col, label_col).mapInPandas(run, ", ".join(f"{n} double" for n in names))
    return parts.agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
