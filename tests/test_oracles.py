"""Every registered query against its SQL twin, run by DuckDB on the same files."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TERMLOOM_TEST_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "labels", "benchmark", "lineitem")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(columns, cursor.fetchall())
    assert len(got) == len(want)
    assert got, "an empty result checks nothing"
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert (math.isclose(a, b, rel_tol=0, abs_tol=2e-9) if isinstance(a, float) else a == b), (g, w)


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["class"] for r in rows} == {"de", "en", "es", "fr"}
    assert max(r["rk"] for r in rows) == 5
