"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as registered
from tallyweir.plans.catalog import QUERIES
from tallyweir.plans.oracle import oracle_statements

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_statements()


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= registered.queries().items() and SQL.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), tables, SQL[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
