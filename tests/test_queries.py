"""Every registered query against its SQL, at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402
from check import TABLES, rows  # noqa: E402
from spark_queries.registry import registry  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry()))
def test_query(spark, db, name):
    got = entry_module.queries()[name](spark, str(SF_DIR)).toPandas()
    want = db.execute(entry_module.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
