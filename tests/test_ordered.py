"""Chunked row-order operators equal the plain windows, heavy keys included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.conftest import rows

from tidelog.operators import ordered


@pytest.fixture(scope="module")
def events(spark):
    """Six hundred rows; one key holds a third, one key is NULL, positions repeat."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, *map(str, range(40))])
        pos = None if i % 50 == 0 else rng.randrange(10_000)
        data.append((key, pos, i, f"v{i}" if i % 4 else None, rng.randrange(9)))
    return spark.createDataFrame(data, "k string, pos long, tie long, v string, amt long")


def window(descending=False):
    return Window.partitionBy("k").orderBy(
        F.col("pos").asc_nulls_first(), F.col("tie").asc_nulls_first()
    )


@pytest.mark.parametrize("size", [5, 37, 1_000_000])
@pytest.mark.parametrize("step", ["next", "previous"])
def test_neighbour(events, size, step):
    shift = F.lead if step == "next" else F.lag
    plain = events.select("*", shift("v").over(window()).alias("n"))
    out = ordered.neighbour(
        events, ["k"], "pos", {"n": "v"}, step=step, ties=("tie",), rows_per_chunk=size
    )
    assert out.columns == plain.columns
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("size", [5, 37, 1_000_000])
def test_carry_forward(events, size):
    w = window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = events.select("*", F.last("v", ignorenulls=True).over(w).alias("c"))
    out = ordered.carry_forward(
        events, ["k"], "pos", {"c": "v"}, ties=("tie",), rows_per_chunk=size
    )
    assert rows(out, *plain.columns) == rows(plain)


def test_carry_forward_over_empty_chunks(spark):
    """A value must cross chunks that hold none, and chunks without any row."""
    data = [("k", 0, "x")] + [("k", p, None) for p in (10, 11, 500, 990, 991, 992)]
    df = spark.createDataFrame(data, "k string, pos long, v string")
    for size in (1, 2, 6):
        out = ordered.carry_forward(df, ["k"], "pos", {"c": "v"}, rows_per_chunk=size)
        assert {r["c"] for r in out.collect()} == {"x"}


@pytest.mark.parametrize("size", [5, 1_000_000])
def test_running_total(events, size):
    known = events.filter("pos is not null").withColumn("pos", F.col("pos") * 1000 + F.col("tie"))
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    plain = known.withColumn("t", F.coalesce(F.sum("amt").over(w), F.lit(0)))
    out = ordered.running_total(known, ["k"], "pos", "amt", "t", rows_per_chunk=size)
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("size", [5, 1_000_000])
def test_as_of_equals_brute_force(spark, size):
    rng = random.Random(3)
    facts = [(i, rng.choice("aab"), rng.randrange(100)) for i in range(80)]
    hist = [(rng.choice("aab"), rng.randrange(100), n) for n in range(60)]
    want = []
    for i, k, at in facts:
        before = [(p, n) for key, p, n in hist if key == k and p <= at]
        want.append((i, k, at, max(before)[1] if before else None))
    f = spark.createDataFrame(facts, "id long, k string, at long")
    h = spark.createDataFrame(hist, "k string, pos long, n long")
    out = ordered.as_of(f, h, ["k"], "at", "pos", ["n"], ties=("n",), rows_per_chunk=size)
    assert rows(out) == sorted(want, key=repr)


def test_without_heavy_keys_nothing_is_cut(events):
    assert ordered.chunked(events, ["k"], ("pos", "tie"), 1000) is None
    cut = ordered.chunked(events, ["k"], ("pos", "tie"), 100)
    assert cut.count() == events.count()


def largest_part(df, keys, order, size):
    cut = ordered.chunked(df, keys, order, size)
    return cut.groupBy(*keys, ordered.CHUNK).count().agg(F.max("count")).first()[0]


def test_clustered_tied_and_missing_positions_are_split(spark):
    """Rows are cut by their number, whatever their positions."""
    burst = spark.range(1000).selectExpr("'k' k", "id pos").unionAll(
        spark.sql("select 'k' k, 1000000000L pos")
    )
    assert largest_part(burst, ["k"], ("pos",), 100) <= 200
    nulls = spark.range(1000).selectExpr("'k' k", "cast(null as long) pos", "id v")
    assert largest_part(nulls, ["k"], ("pos",), 100) <= 200
    ties = spark.range(1000).selectExpr("'k' k", "5L pos", "id v")
    assert largest_part(ties, ["k"], ("pos",), 100) <= 200


def test_many_heavy_keys(spark):
    """Every heavy key is cut; there is no list of them that could be full."""
    df = spark.range(1500).selectExpr("id % 150 k", "id div 150 pos", "id v")
    assert largest_part(df, ["k"], ("pos",), 5) <= 20
    out = ordered.neighbour(df, ["k"], "pos", {"n": "v"}, rows_per_chunk=5)
    assert out.filter("n is null").count() == 150
    assert out.filter("n <> v + 150").count() == 0


@pytest.mark.parametrize("size", [3, 1_000_000])
def test_rows_without_a_position_come_first(spark, size):
    """A snapshot row's value is carried into every later row, without ties as well."""
    data = [("k", None, True)] + [("k", i, None) for i in range(8)]
    df = spark.createDataFrame(data, "k string, pos long, v boolean")
    out = ordered.carry_forward(df, ["k"], "pos", {"c": "v"}, rows_per_chunk=size)
    assert [r["c"] for r in out.collect()] == [True] * 9
    after = ordered.neighbour(df, ["k"], "pos", {"n": "pos"}, rows_per_chunk=size)
    assert rows(after, "pos", "n") == rows(spark.createDataFrame(
        [(None, 0)] + [(i, i + 1 if i < 7 else None) for i in range(8)], "pos long, n long"))
    total = ordered.running_total(df.withColumn("a", F.lit(1)), ["k"], "pos", "a", "t", rows_per_chunk=size)
    assert rows(total, "pos", "t") == rows(spark.createDataFrame(
        [(None, 0)] + [(i, i + 1) for i in range(8)], "pos long, t long"))
    hist = spark.createDataFrame([("k", None, 1), ("k", 3, 2)], "k string, at long, n long")
    found = ordered.as_of(df.select("k", "pos"), hist, ["k"], "pos", "at", ["n"], rows_per_chunk=size)
    assert sorted(r["n"] for r in found.filter("pos is not null").collect()) == [1] * 3 + [2] * 5
