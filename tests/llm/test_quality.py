import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, as_rows, clashing, words
from tidelog.llm import quality


def counts(text):
    raw = text or ""
    w = raw.encode().split()
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in raw.encode().split(b"\n") if x.strip()]
    return (
        len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in raw),
        len(lines) - len(set(lines)), len(covered),
    )


def test_counts_equal_brute_force(spark, frame, docs):
    more = [(9001, "a b c d e f a b c d e a b\na b\n\n \na b", "en", "a", 0), (9002, "## $x |\n##\n##", "en", "a", 0)]
    got = quality.judge(clashing(frame.unionAll(spark.createDataFrame(more, DOCS))))
    rows = {r["doc_id"]: r for r in got.collect()}
    for i, text, *_ in [*docs, *more]:
        r, want = rows[i], counts(text)
        assert tuple(r[c] for c in quality.COUNTS[:5]) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert len(rows) == len(docs) + 2


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        text = words(rng, rng.randint(12, 300))
        if i % 10 == 0:
            text = " ".join(f"{w}###" for w in text.split())
        if i % 25 == 1:
            text = text.upper()
        rows.append((i, text, "en" if i % 3 else None, ("a", "b", None)[i % 3], 0))
    out = quality.judge(spark.createDataFrame(rows, DOCS).repartition(6))
    gone = {r["doc_id"] for r in out.filter("not kept and not base_failed").collect()}
    assert gone == {i for i in range(900) if i % 10 == 0 or i % 25 == 1}
    again = quality.judge(spark.createDataFrame(rows[::-1], DOCS).repartition(3))
    assert as_rows(out, "doc_id", "distance", "kept") == as_rows(again, "doc_id", "distance", "kept")


def vectors_of(spark, groups):
    """Rows of whole numbers per group, each a source of one language."""
    rows = [(f"2{g}", "1x", "0", *map(int, r)) for g, x in groups.items() for r in x]
    return spark.createDataFrame(rows, "k2 string, k1 string, k0 string, " + ", ".join(f"q{i} long" for i in range(6)))


def least_determinant(x, share=quality.KEPT_SHARE):
    """Over all subsets of that share: the least log determinant, the floor added, and its mean."""
    h = math.ceil(len(x) * share)
    best = min(
        (np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) + np.eye(6) * quality.UNIT**2)[1], c)
        for c in itertools.combinations(range(len(x)), h)
    )
    return best[0], x[list(best[1])].mean(axis=0)


def test_estimates_have_the_least_determinant(spark):
    """Small groups with outliers, against all subsets; outliers on one side mislead means,
    a wide dimension misleads unit variances."""
    rng = np.random.RandomState(0)
    groups = {}
    for g in range(6):
        x = rng.multivariate_normal(rng.randint(-900, 900, 6), np.diag([9, 4, 1, 1, 2, 30.0 + 400 * (g == 5)]) * 900, 12)
        far = x[: 1 + g % 3]
        far += rng.choice([-1, 1], 6) * rng.randint(2500, 6000, (len(far), 6))
        groups[g] = np.round(x).astype(int)
    got = {r["key"]: r for r in quality.estimates(vectors_of(spark, groups)).collect()}
    for g, x in groups.items():
        logdet, centre = least_determinant(x)
        assert abs(got[f"2{g}"]["logdet"] - logdet) < 1e-6
        assert np.allclose(got[f"2{g}"]["centre"], centre) and got[f"2{g}"]["n_docs"] == 12


def test_steps_end_at_a_fixed_point(spark):
    """The subset nearest to the estimate gives the estimate again, or no lower determinant."""
    rng = np.random.RandomState(1)
    x = np.round(rng.standard_t(2, (400, 6)) * 300).astype(int)
    got = next(r for r in quality.estimates(vectors_of(spark, {0: x})).collect() if r["key"] == "20")
    d = x - np.array(got["centre"])
    d2 = np.einsum("ij,jk,ik->i", d, np.array(got["inverse"]).reshape(6, 6), d)
    bins = np.floor(np.log2(np.maximum(0, d2) + 1) * quality.BINS)
    near = x[bins <= np.sort(bins)[math.ceil(400 * quality.KEPT_SHARE) - 1]]
    again = np.linalg.slogdet(np.cov(near.T, bias=True) + np.eye(6) * quality.UNIT**2)[1]
    assert again >= got["logdet"] - 1e-6
    assert abs(len(near) - 300) < 20


def test_verdicts_are_continuous_in_group_size(spark):
    """A group of one has nearly its parent's estimate; one more document moves it a little."""
    rng = np.random.RandomState(2)
    many = np.round(rng.normal(0, 200, (400, 6))).astype(int)
    centres = []
    for n in (1, 40, 41, 399, 400):
        few = np.round(np.full((n, 6), 1000) + rng.normal(0, 1, (n, 6))).astype(int)
        out = {r["k2"]: r for r in quality.group_estimates(vectors_of(spark, {"big": many, "few": few})).collect()}
        centres.append(np.array(out["2few"]["centre"]).mean())
    assert centres[0] < 60 and abs(centres[2] - centres[1]) < 40 and abs(centres[4] - centres[3]) < 40
    assert centres[0] < centres[1] < centres[3]


def test_huge_components(spark):
    """A ratio of millions is summed exactly and judged like any other outlier."""
    rng = random.Random(1)
    rows = [(i, words(rng, 60), "en", "a", 0) for i in range(60)]
    rows += [(100 + i, "#" * 4_000_000 + " " + words(rng, 12), "en", "a", 0) for i in range(3)]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    assert all(out[i]["kept"] for i in range(60)) and not any(out[100 + i]["kept"] for i in range(3))


def test_salted_join_gives_the_same(spark, frame, monkeypatch):
    one = as_rows(quality.judge(frame), "doc_id", "distance", "kept")
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    assert as_rows(quality.judge(frame), "doc_id", "distance", "kept") == one


def test_empty_and_null(spark):
    assert quality.judge(spark.createDataFrame([], DOCS)).count() == 0
    out = quality.judge(spark.createDataFrame([(None, None, None, None, None)] * 2, DOCS))
    assert as_rows(out, "doc_id", "n_words", "kept") == [(None, 0, False)] * 2
    assert out.filter(F.col("base_failed")).count() == 2
