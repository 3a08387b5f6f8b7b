"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

NAMES = sorted(E.queries())
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "commit_count", "active_repositories", "meeting_minutes", "meeting_count"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_documented():
    assert set(SQL) <= set(NAMES)
    assert len(NAMES) >= 90


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, cur.fetchall())
