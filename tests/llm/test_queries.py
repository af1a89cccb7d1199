"""Registered queries with SQL against DuckDB, and the registry itself."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def test_thirteen_operators_and_the_pipeline():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, DATA).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
