"""Every query against its DuckDB statement on the smallest test data."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical
from tidemark.oracle import ORACLES
from tidemark.plans import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, db, name):
    got = entry.queries()[name](spark, str(FOLDER))
    want = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(
        names, want.fetchall()
    )
