"""Every registered query gives exactly the rows of its SQL twin."""

from __future__ import annotations

import comparing
import pytest

import __spark_entry__ as entry
from gridtide.catalog import oracle
from gridtide.catalog.queries import QUERIES

ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return comparing.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, sf_dir, connection):
    assert comparing.differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == ""
