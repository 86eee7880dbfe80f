"""Every registered query with SQL beside it, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from fleetmart.registry.base import ORACLE, QUERIES, TABLES

FOLDER = "/root/testdata/sf0.001"
SLOW = {"refresh_all"}  # counts of the run that refresh_pipeline checks row by row
KEYS = [k for k in QUERIES if k not in SLOW]

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, engine, key):
    df = entry.queries()[key](spark, FOLDER)
    columns = sorted(df.columns)
    mine = sorted((tuple(map(str, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()))
    result = engine.execute(entry.oracle_sql()[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())
    assert mine == theirs
