"""Every registered query runs; those with SQL agree with DuckDB value by value."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, duck  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    ok, message, _ = compare(spark, con, name, sf, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
