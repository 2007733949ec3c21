"""Every registered query agrees with its SQL on DuckDB, and the entry point runs."""
import pytest

import __spark_entry__ as entry_points
from check_queries import compare, connect
from rollbook.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    verdict, _ = compare(spark, con, FOLDER, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert all(query.sql for query in QUERIES.values())
    assert set(QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())
