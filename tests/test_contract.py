"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from contract.oracle import ORACLE_SQL
from contract.queries import QUERIES
from contract.tables import NAMES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(records):
    def cell(value):
        if value is None or value != value:
            return ""
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        return str(value)

    return sorted(tuple(cell(v) for v in record) for record in records)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sql.execute(f"SELECT {quoted} FROM ({oracle_sql()[name]})").fetchall()
    assert canonical(found.select(*columns).collect()) == canonical(expected)


def test_entry(spark):
    assert entry(spark).columns[0] == "FECHA" and entry(spark).count() > 0
