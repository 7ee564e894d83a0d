"""Every registered query with SQL equals DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, database, name):
    assert compare(spark, database, FOLDER, name, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["k", "t", "method", "filled"] and frame.where("filled is null").count() == 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
