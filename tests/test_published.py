"""Result documents in their published shapes."""

import json

import pytest
from pyspark.sql import functions as F

from parley.session import scratch_path
from parley.sources import files as IO


def written(spark, docs):
    path = scratch_path(spark, "published")
    IO.write_result_documents(docs, path)
    return path, [json.loads(r["value"]) for r in spark.read.text(path).collect()]


def test_validation_documents(spark):
    log = spark.createDataFrame([(i, "template" if i % 3 else "model", f"q{i}", f"r{i}", 0.5 if i % 3 else 2.0) for i in range(20)], "pos long, run string, query string, response string, response_time double")
    path, docs = written(spark, IO.published_documents(log, "validation", chunk=5))
    assert sorted((len(d["template_results"]), len(d["model_results"])) for d in docs) == [(3, 0), (5, 2), (5, 5)]
    assert {(d["avg_template_time"], d["avg_model_time"], d["speedup_factor"]) for d in docs} == {(0.5, 2.0, 4.0)}
    first = max(docs, key=lambda d: len(d["model_results"]))
    assert [r["query"] for r in first["model_results"]] == ["q0", "q3", "q6", "q9", "q12"] and list(first["model_results"][0]) == ["query", "response", "response_time"]
    back = IO.read_published_results(spark, path, "validation", multi_line=False)
    assert back.count() == 20 and back.where("run = 'model'").count() == 7


def test_evaluation_and_inference_documents(spark):
    log = spark.range(7).select(F.col("id").alias("pos"), F.lit("q").alias("query"), F.lit("t").alias("template_response"), F.lit("m").alias("model_response"), F.lit(0.0).alias("template_time"), F.lit(3.0).alias("model_time"))
    _, docs = written(spark, IO.published_documents(log, "evaluation", chunk=100))
    assert len(docs) == 1 and len(docs[0]["responses"]) == 7 and docs[0]["speedup"] == 0.0 and docs[0]["model_avg_time"] == 3.0
    log = spark.range(3).select(F.col("id").alias("pos"), F.lit("i").alias("input"), F.lit("t").alias("target"), F.lit("g").alias("generated"), F.lit(1.5).alias("inference_time"))
    path, docs = written(spark, IO.published_documents(log, "inference"))
    assert docs == [{"results": [{"input": "i", "target": "t", "generated": "g", "inference_time": 1.5}] * 3, "avg_inference_time": 1.5}]
    assert IO.read_published_results(spark, path, "inference", multi_line=False).count() == 3
    with pytest.raises(ValueError):
        IO.published_documents(log, "other")
