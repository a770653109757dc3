"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from tidelog.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["op", "n_keys"]
