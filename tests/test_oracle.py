"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_names():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    status, detail = compare(spark, db, name, FOLDER)
    assert status in ("ok", "rows"), detail
