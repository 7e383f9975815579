"""Driver contract: entry(), queries(), oracle_sql()."""

import duckdb

import __spark_entry__ as entry
from parley.sources.tables import TABLES
from tests.conftest import SF_SMALL

#: queries of the optional subpackage, which has tests of its own
OPTIONAL = {k for k in entry.queries() if k.startswith("op") and k[2].isdigit()} | {"pipeline"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["conv_id", "turn", "query", "intent", "route", "response", "prompt"]


def test_every_query_has_oracle_unless_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(q) - set(o) <= OPTIONAL
    assert set(o) <= set(q)


def test_oracles_parse_and_run_on_smoke_data():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.execute(sql).fetchall()


def test_some_queries_match_oracle_on_smoke_data(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("split_train_val_test", "answer_questions_probe", "length_stats", "encode_pairs", "evaluate_classifier", "select_best_by_accuracy"):
        df = entry.queries()[name](spark, SF_SMALL)
        got = sorted(map(lambda r: tuple(str(x) for x in r), df.select(*sorted(df.columns)).collect()))
        cur = con.execute(entry.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted(tuple(str(r[i]) for i in idx) for r in cur.fetchall())
        assert got == exp, name
