"""Every registered query against its SQL on DuckDB, value for value ($TEST_SF, default 0.001)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_sql import TABLES, compare

SF_DIR = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    status, _, _, _, detail = compare(spark, con, name, SF_DIR, QUERIES, ORACLES)
    assert status in ("ok", "rows-only"), detail


def test_entry(spark):
    assert entry.entry(spark).count() > 0
