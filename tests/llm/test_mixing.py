import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, as_rows, clashing
from tidelog.llm import mixing


def fill(sizes, weights, budget, epochs):
    """Clamp and reshare until none is above."""
    clamped = set()
    while True:
        left = budget - sum(epochs * sizes[i] for i in clamped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in clamped)
        out = [epochs * s if i in clamped else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in clamped and out[i] >= epochs * s}
        if not over:
            return out
        clamped |= over


@pytest.mark.parametrize("sizes", [[10, 100, 1000, 3, 0], [5, 5, 5], [1000, 1, 1], [7], [0, 0]])
def test_water_level(spark, sizes):
    rows = [(f"1s{i}", s, 1) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "key string, source_size long, n_docs long")
    got = dict(as_rows(mixing.water_fill(df, (5, 2, 1), 1.5, 2), "key", "target"))
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 1.5 * sum(sizes), 2)
    assert [got[k] for k in sorted(got)] == pytest.approx(want)


def test_rows_and_bounds(frame, docs):
    out = mixing.mix(clashing(frame)).collect()
    assert len(out) == len(docs)
    sizes = {d[0]: len([w for w in _split(d[1] or "")]) for d in docs}
    assert {r["doc_id"]: r["size"] for r in out} == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in out)


def _split(text):
    return text.encode().split()


def test_taken_is_near_the_target(spark):
    rows = [(i, "w " * (1 + (i * 7919) % 400), "en", f"s{i % 5}", 0) for i in range(4000)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS))
    out = out.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(out) >= 2
    for r in out:
        assert r["taken"] == pytest.approx(r["target"], abs=400)


def test_reruns_and_repeats(spark, frame):
    columns = ("doc_id", "size", "source_size", "target", "taken")
    assert as_rows(mixing.mix(frame), *columns) == as_rows(mixing.mix(frame.repartition(3)), *columns)
    twice = frame.unionAll(frame)
    assert mixing.mix(twice).count() == 2 * frame.count()


def test_empty_and_all_null(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    out = mixing.mix(spark.createDataFrame([(None, None, None, None, None)] * 2, DOCS))
    assert as_rows(out, "doc_id", "size", "target", "taken") == [(None, 0, 0.0, 0)] * 2


def test_no_python_in_the_plan(frame):
    plan = mixing.mix(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
