"""Queries with SQL twins against DuckDB on whole tables."""

import duckdb
import pytest

from termloom.llm.oracles import ORACLES
from termloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(str, cursor.fetchall()))
