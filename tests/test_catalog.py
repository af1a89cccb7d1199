"""Every registered query against its DuckDB oracle (sf0.001), and entry()."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES
from tools.oracle_check import norm_rows

DATA = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    own = {q for q in set(QUERIES) - set(SQL) if not re.match(r"op\d+_|pipeline$", q)}
    assert not own
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(q for q in SQL if not re.match(r"op\d+_|pipeline$", q)))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert norm_rows(rows, df.columns) == norm_rows(res.fetchall(), res.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["a_id", "b_id", "similarity"]
    assert df.count() > 0
