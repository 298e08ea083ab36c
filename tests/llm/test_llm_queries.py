"""Registered queries: against their SQL on the smallest given tables, or by their shape."""

import os

import pytest

from surveyqa.llm.oracle import ORACLE_SQL
from surveyqa.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def cell(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    sql = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(map(cell, r)) for r in found.select(*columns).collect()) == sorted(tuple(map(cell, r)) for r in expected)


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
