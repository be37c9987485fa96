"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences
from checks.jobs import QUERIES
from checks.oracles import ORACLES
from tests.conftest import FOLDER


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    found, rows = differences(spark, db, FOLDER, name)
    assert found is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["partition", "records", "digest"]
