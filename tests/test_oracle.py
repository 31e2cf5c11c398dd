"""Every query with a DuckDB twin gives the same rows at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

from ringfold.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    names = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(map(key, map(tuple, got.select(*names).collect()))) == sorted(map(key, want))
