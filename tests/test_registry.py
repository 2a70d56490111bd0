"""Every registered query against its SQL on the test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from revaudit.catalog import oracles
from revaudit.catalog import queries as registered

QUERIES = registered.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    found = differences(QUERIES[name](spark, sf_dir), db, ORACLES[name])
    assert not found, "\n".join(found)
