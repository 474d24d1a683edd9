"""Every registered query against its checking SQL on the smallest driver tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

FOLDER = "/root/testdata/sf0.001"
if not Path(FOLDER).exists():
    pytest.skip("driver tables are not here", allow_module_level=True)

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402
from check_queries import TABLES, canonical  # noqa: E402

# The queries of optional subpackages have tests of their own.
QUERIES, ORACLES = entry_module.QUERIES, entry_module.ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    want = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
