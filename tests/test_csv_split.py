"""Large CSV files read in blocks, and the quarantine of damaged records."""

import json
import random

import pytest
from pyspark.sql import types as T

from parley.session import scratch_path
from parley.sources import csv_split as C
from parley.sources.files import PAIRS_SCHEMA, read_pairs_csv, write_pairs_csv

DDL = "id long, input_text string, target_text string, category string, intent string"


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def wild_rows(seed, n):
    r = random.Random(seed)
    piece = ["a", "word", ",", '"', '""', "\n", "\n\n", "\r\n", " ", "é中", "\\N", "\\", "'", ";", "x" * 70]
    text = lambda: None if r.random() < 0.1 else "".join(r.choice(piece) for _ in range(r.choice([0, 1, 3, 9, 40])))
    return [(i, text(), text(), r.choice(["A", None, ""]), r.choice(["x", "y,z"])) for i in range(n)]


@pytest.mark.parametrize("size", [150, 1000, 1 << 20])
def test_blocks_give_the_rows_of_the_whole_file(spark, small_blocks, size):
    path = scratch_path(spark, "csv")
    write_pairs_csv(spark.createDataFrame(wild_rows(size, 60), DDL).coalesce(1), path)
    want = sorted(map(str, read_pairs_csv(spark, path).collect()))
    small_blocks(size)
    found = C.read_csv_records(spark, path, PAIRS_SCHEMA)
    small_blocks(1 << 20)  # what is written meanwhile is read in few tasks
    assert sorted(map(str, found.rows.collect())) == want and len(want) == 60
    assert found.damaged.count() == 0


def test_one_large_file_is_read_by_many_tasks(spark, small_blocks):
    path = scratch_path(spark, "csv")
    rows = [(i, f"q {i}\nsecond, \"line\" " + "y" * 300, f"a {i}", "A", "x") for i in range(4000)]
    write_pairs_csv(spark.createDataFrame(rows, DDL).coalesce(1), path)
    small_blocks(1 << 16)
    lines = C._lines(spark, path)
    assert C.block_states(lines).count() > 15
    assert C._records_of_blocks(lines, C.block_states(lines)).rdd.getNumPartitions() > 15
    got = C.read_csv_records(spark, path, PAIRS_SCHEMA).rows
    assert sorted(map(tuple, got.collect())) == rows


def test_damaged_records_go_to_quarantine(spark, small_blocks, tmp_path):
    head = "id,input_text,target_text,category,intent\n"
    (tmp_path / "a.csv").write_text(head + '1,q,a,c,i\n2,too,few\n3,"line\nbreak",a,c,i\n\nx,q,a,c,i\n4,q,a,c,i,more\r\n5,"q, ""x""",a,c,i\r\n')
    (tmp_path / "b.csv").write_text(head + '6,q,a,c,i\n7,"never closed,a,c,i\n8,q,a,c,i\n')
    (tmp_path / "c.csv").write_text(head)
    (tmp_path / "d.csv").write_text("")
    for size in (40, 1 << 20):
        small_blocks(size)
        found = C.read_csv_records(spark, str(tmp_path), PAIRS_SCHEMA)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))  # what is written meanwhile is read in few tasks
        assert sorted(r["id"] for r in found.rows.collect()) == [1, 3, 5, 6]
        assert {(r["file"][-5:], r["reason"], r["records"]) for r in found.counts().collect()} == {
            ("a.csv", "too few fields", 1), ("a.csv", "value of another type", 1), ("a.csv", "too many fields", 1), ("b.csv", "unclosed quote", 1)}
        assert {r["record"] for r in found.damaged.where("reason = 'unclosed quote'").collect()} == {'7,"never closed,a,c,i\n8,q,a,c,i'}
    report = {r["name"]: r["value"] for r in C.quarantine_report(found).collect()}
    assert report == {"read": "4", "too few fields": "1", "too many fields": "1", "value of another type": "1", "unclosed quote": "1"}


def test_blocks_that_changed_are_an_error(spark, small_blocks):
    path = scratch_path(spark, "csv")
    write_pairs_csv(spark.createDataFrame(wild_rows(1, 100), DDL).coalesce(1), path)
    small_blocks(1 << 20)
    states = C.materialize(C.block_states(C._lines(spark, path)), "states")
    small_blocks(500)
    with pytest.raises(Exception, match="blocks changed"):
        C._records_of_blocks(C._lines(spark, path), states).collect()


def test_damaged_documents_go_to_quarantine(spark, tmp_path):
    schema = T.StructType([T.StructField("run", T.StringType()), T.StructField("n", T.LongType())])
    (tmp_path / "a.json").write_text('{"run": "a", "n": 1}\n{"run": "b", \n{"run": "c", "n": "many"}\n{"run": "d"}\n')
    found = C.read_json_records(spark, str(tmp_path / "a.json"), schema)
    assert {tuple(r) for r in found.rows.collect()} == {("a", 1), ("d", None)}
    assert {(r["reason"], r["record"]) for r in found.damaged.collect()} == {("no JSON", '{"run": "b", '), ("value of another type", '{"run": "c", "n": "many"}')}
    (tmp_path / "b.json").write_text(json.dumps({"run": "e", "n": 2}, indent=2))
    (tmp_path / "c.json").write_text('{"run": "f",\n "n"')
    both = C.read_json_records(spark, [str(tmp_path / "b.json"), str(tmp_path / "c.json")], schema, multi_line=True)
    assert [tuple(r) for r in both.rows.collect()] == [("e", 2)] and [r["reason"] for r in both.damaged.collect()] == ["no JSON"]
