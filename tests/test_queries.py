"""Every query against its check SQL, or at least its schema and rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", queries())
def test_query(spark, connection, name):
    outcome, _ = compare(spark, connection, FOLDER, name)
    assert outcome.startswith(("equal", "rows only"))


def test_entry(spark):
    assert entry(spark).columns[0] == "user_id"
