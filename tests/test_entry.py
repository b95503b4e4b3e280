"""Each registered query of the library equals its SQL on the smallest tables; the entry point works without ``llm``."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from strandweave.plans import QUERIES, SQL
from strandweave.plans.fixtures import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def plain(v):
    if isinstance(v, float | Decimal):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
