import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import as_rows, clashing
from tidelog.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=2):
    """Full comparison with exact integers. Rows: (vec_id, whole components, label)."""
    x = np.array([r[1] for r in rows], object).reshape(len(rows), codes.PARTS, -1)
    first = {}
    for i, x0, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(r[1]))):
        first.setdefault(i, x0)
    seeds = list(first.values())[: codes.ENTRIES]
    books = [[list(s[p * x.shape[2] : (p + 1) * x.shape[2]]) for s in seeds] for p in range(codes.PARTS)]
    for k in range(rounds + 1):
        best = [[min((sum((a - b) ** 2 for a, b in zip(v[p], c)), e) for e, c in enumerate(books[p])) for p in range(codes.PARTS)] for v in x]
        if k == rounds:
            break
        for p in range(codes.PARTS):
            for e in range(len(seeds)):
                mine = [v[p] for v, b in zip(x, best) if b[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    text = ",".join(str(v) for part in books for c in part for v in c)
    out, total = [], {}
    for r, b in zip(rows, best):
        total[r[2]] = total.get(r[2], 0) + sum(d for d, _ in b)
    for r, b in zip(rows, best):
        out.append((r[0], "".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b), total[r[2]], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def whole(v):
    return [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v]


@pytest.mark.parametrize("spread", [0.02, 0.5, 300.0])
def test_codes_equal_a_full_comparison(spark, spread):
    """From many ties (a narrow spread) to bounds past 16 bits (a wide one)."""
    rng = np.random.RandomState(3)
    middle = rng.normal(0, spread, (40, 32))
    v = middle[rng.randint(40, size=400)] + rng.normal(0, spread / 3, (400, 32))
    rows = [(int(i), [float(c) for c in r], (None, 1, 2)[i % 3]) for i, r in enumerate(v)]
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = codes.codes(df)
    want = brute([(i, whole(r), lab) for i, r, lab in rows])
    assert as_rows(got, "vec_id", "code", "error", "label_error", "codebooks_sha256") == want


def test_bounds_spare_work_and_stay_bounds(spark):
    """After a round most parts are settled by their bounds; every bound is below the truth."""
    rng = np.random.RandomState(1)
    x = rng.randint(-60, 60, (3000, 4)) + 400 * rng.randint(0, 5, (3000, 4))
    old = x[:64].astype(np.int64)
    near, low, outer, d2 = codes._closest(x.astype(np.int64), old, 16)
    new = np.array([x[near[:, 0] == e].sum(0) // max(1, (near[:, 0] == e).sum()) if (near[:, 0] == e).any() else old[e] for e in range(64)])
    moved = np.ceil(np.sqrt(((new - old) ** 2).sum(1))).astype(np.int64)
    near, low, outer, d2, need = codes.assign_part(x.astype(np.int64), new, moved, near.copy(), low, outer, 8)
    full = ((x[:, None, :] - new[None]) ** 2).sum(2)
    assert (near[:, 0] == full.argmin(1)).all() and (d2 == full.min(1)).all()
    assert near.shape[1] == 8 and (need == 1).mean() > 0.2 and (need == 0).mean() < 0.6
    real = np.sqrt(np.take_along_axis(full, near, axis=1))
    assert (low <= real + 1e-9).all()
    rest = full.astype(float)
    np.put_along_axis(rest, near, np.inf, axis=1)
    assert (outer <= np.sqrt(rest.min(1)) + 1e-9).all()


def test_width_follows_what_rows_needed():
    assert codes.next_width({0: 100}, 16) == 16
    assert codes.next_width({0: 5, 1: 900, 2: 80, 9: 15, 14: 5}, 16) == 9
    assert codes.next_width({1: 1000}, 16) == codes.LEAST_WIDTH
    assert codes.next_width({1: 10, 16: 1000}, 16) == 16


def test_unusable_vectors_go(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float((i * 7 + c) % 5) for c in range(16)], i % 2) for i in range(6)]
    bad = [(10, None, 1), (11, [nan] * 16, 1), (12, [inf] + [0.0] * 15, 1), (13, [-inf] + [0.0] * 15, 1),
           (14, [None] + [0.0] * 15, 1), (15, [], 1), (16, [1.0] * 15, 1), (17, [1.0] * 32, 1)]
    got = codes.codes(spark.createDataFrame(good + bad, SCHEMA))
    assert as_rows(got, *got.columns) == brute([(i, whole(v), lab) for i, v, lab in good])


def test_few_repeated_and_null_ids(spark):
    v = lambda k: [float(k)] * 16
    rows = [(3, v(1), None), (3, v(0), None), (3, v(0), 4), (None, v(9), 4), (None, v(8), 4), (1, v(-0.003), 4), (2, v(7), None)]
    got = codes.codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert as_rows(got, *got.columns) == brute([(i, whole(x), lab) for i, x, lab in rows])


def test_only_null_ids_and_no_rows(spark):
    rows = [(None, [1.0] * 16, None), (None, [2.0] * 16, None)]
    got = codes.codes(spark.createDataFrame(rows, SCHEMA))
    assert as_rows(got, *got.columns) == brute([(i, whole(x), lab) for i, x, lab in rows])
    for none in ([], [(1, None, 1)]):
        out = codes.codes(spark.createDataFrame(none, SCHEMA))
        assert out.count() == 0 and out.columns == got.columns


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="too large for 64-bit"):
        codes.codes(spark.createDataFrame([(1, [3e38] * 16, 1)], SCHEMA)).collect()


def test_a_hot_label_meets_landed_sums(spark):
    """No window over labels: rows of one label are not gathered."""
    rows = spark.range(50).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"), F.lit(b"").alias("code"), F.col("id").alias("error"))
    out = codes.label_errors(rows)
    assert "Window" not in out._jdf.queryExecution().toString()
    assert {r["label_error"] for r in out.collect()} == {49 * 25}
