"""Driver contract at sf0.001: entry() runs, and every query equals its DuckDB oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, _rows

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["subject", "count"]
    assert 0 < len(df.collect()) <= 30


# The queries of the optional training-data operators are tested beside them.
OWN = sorted(entry._QUERIES)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    want = res.fetchall()
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(res.columns, want)
