"""Registered queries against their SQL, and all of them for a result."""

import duckdb
import pytest

import check
import corpus_pipeline  # noqa: F401
from tidelog.llm import queries  # noqa: F401
from tidelog.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    con = check.connect(SF)
    got = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    a = check.normal([tuple(r) for r in got.collect()], got.columns)
    b = check.normal(cur.fetchall(), [c[0] for c in cur.description])
    assert a == b


def test_a_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])


def test_sql_is_duckdb():
    assert duckdb.__version__
