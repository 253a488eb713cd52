"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from mostrador.catalog.oracle import ORACLE  # noqa: E402
from mostrador.catalog.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in compare.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    verdict, _ = compare.compare(spark, db, SF_DIR, name)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_flagship_has_one_row(spark):
    assert entry(spark).count() == 1
