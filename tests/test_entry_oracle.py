"""The driver contract: entry() runs, every oracle has a query, and every query with an oracle
returns the same rows as DuckDB on the smallest data folder."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from corpusprep.sources.tables import TABLES
from tests.conftest import SF0001
from tools.oracle_check import rows

SQL = oracle_sql()


def test_entry(spark):
    df = entry(spark)
    out = df.collect()
    assert df.columns == ["lang", "docs", "words", "mean_words"] and len(out) > 0


def test_registry():
    q = queries()
    assert set(SQL) <= set(q)
    assert len(q) >= 100


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, con, name):
    df = queries()[name](spark, SF0001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert rows(s_cols, s_rows) == rows(d_cols, d_rows)
