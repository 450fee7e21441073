"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry._QUERIES) == set(entry._SQL)


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query(spark, tables, name):
    assert mismatch(entry.queries()[name](spark, SF_DIR), tables, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {row["lang"] for row in rows} <= {"de", "en", "es", "fr"}
    assert sum(row["records"] for row in rows) > 0
