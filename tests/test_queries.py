"""Every registered query against its SQL on the test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import assert_equal, connect

from varve.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, oracle, name):
    assert_equal(QUERIES[name](spark, SF_DIR), SQL[name], oracle)


def test_names_are_plain():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
