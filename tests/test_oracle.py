"""Every query with a SQL statement equals DuckDB's result on the same tables (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from conftest import SF001


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = E.queries()[name](spark, SF001).toArrow()
    want = con.sql(E.oracle_sql()[name]).to_arrow_table()
    assert rows_of(got) == rows_of(want)
