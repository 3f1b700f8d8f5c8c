"""Every registered query against its SQL on the smallest scale."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scrivel.plans.registry import QUERIES

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _values(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(frame.where(frame.notna(), None).itertuples(index=False, name=None), key=repr)


def test_all_queries_of_the_package_are_registered():
    assert set(QUERIES) <= set(queries())
    assert {name for name, (_, text) in QUERIES.items() if text} <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    got = queries()[name](spark, str(SF_DIR)).toPandas()
    want = sql.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert _values(got) == _values(want)


def test_entry(spark):
    assert entry(spark).count() == 200
