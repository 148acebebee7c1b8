"""Every registered query against its DuckDB counterpart on the smallest tables."""

import duckdb  # noqa: F401
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_match():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert not compare(spark, con, SF, name).startswith("DIFFERENT")
