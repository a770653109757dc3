import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, as_rows, clashing, words
from tidelog.llm import discriminant
from tidelog.llm import queries as _queries  # noqa: F401  registers
from tidelog.llm.registry import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def junk(rng, n):
    kind = rng.randrange(3)
    w = words(rng, n).split()
    if kind == 0:
        return " ".join(f"{x.upper()}!!" for x in w)
    return " | ".join(w) if kind == 1 else " ".join(x for x in w[: n // 20 + 1] for _ in range(20))


def table(spark, n=900, seed=2):
    """Documents of ids from 1 on, every sixth of them junk, and labels of three in four."""
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        size = rng.randint(20, 200)
        rows.append((i, junk(rng, size) if i % 6 == 0 else words(rng, size), "en", "a", 0))
    labels = [(i, int(i % 6 > 0), 0) for i in range(1, n + 1) if i % 4]
    return rows, spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)


def brute(rows, labels):
    """The same model by plain formulas: covariances by numpy, densities by inverse and determinant."""
    x = discriminant.vectors([r[1] or "" for r in rows]) / discriminant.UNIT
    learn = [i for i, r in enumerate(rows) if zlib.crc32(str(r[0]).encode()) % 3 != 1 and r[0] in labels]
    by = [np.array([x[i] for i in learn if labels[rows[i][0]] == c]) for c in (0, 1)]
    scatter = [len(b) * np.cov(b.T, bias=True) for b in by]
    pooled = sum(scatter) / len(learn)
    log = []
    for b, s in zip(by, scatter):
        cov = (s + discriminant.SHARED * pooled) / (len(b) + discriminant.SHARED)
        cov += np.diag(np.array(list(discriminant.FLOOR.values())) ** 2)
        d = x - b.mean(axis=0)
        d2 = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
        log.append(np.log((len(b) + 1) / (len(learn) + 2)) - np.linalg.slogdet(cov)[1] / 2 - d2 / 2)
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def test_scores_equal_plain_formulas(spark):
    rows, docs, labels = table(spark)
    got = {r["doc_id"]: r for r in discriminant.classify(clashing(docs), labels.withColumn("x", F.lit(1))).collect()}
    want = brute(rows, {r["doc_id"]: r["quality"] for r in labels.collect()})
    for r, score in zip(rows, want):
        assert abs(got[r[0]]["score"] - score) < 1e-6 and got[r[0]]["predicted"] == (score >= 0.5)
        assert got[r[0]]["held_out"] == (zlib.crc32(str(r[0]).encode()) % 3 == 1)


def test_held_out_labels_are_not_learned(spark):
    _, docs, labels = table(spark, 300)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = discriminant.classify(docs, labels), discriminant.classify(docs, turned)
    assert as_rows(one, *one.columns) == as_rows(other, *one.columns)


def test_inputs_are_the_text_alone(spark):
    _, docs, labels = table(spark, 300)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(7)})
    one = discriminant.classify(docs, labels)
    assert as_rows(one, *one.columns) == as_rows(discriminant.classify(other.repartition(2), labels), *one.columns)


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(zip(*pq.read_table(f"{sf}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values()))
    out = [r for r in QUERIES["op11_quality_discriminant"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert len(out) > 80
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in out)
    assert right >= 0.97 * len(out)
    low = [r["score"] for r in out if not labels[r["doc_id"]]]
    high = [r["score"] for r in out if labels[r["doc_id"]]]
    assert sum(a < b for a in low for b in high) >= 0.98 * len(low) * len(high)


def test_small_shares_of_a_class_and_no_labels(spark):
    _, docs, labels = table(spark, 120)
    assert {r["score"] for r in discriminant.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in discriminant.classify(docs, labels.filter("quality = 0")).collect()} == {0.0}
    learned = labels.filter(~discriminant.is_held_out())
    one = learned.filter("quality = 0").orderBy("doc_id").limit(1)
    out = discriminant.classify(docs, learned.filter("quality = 1").unionAll(one))
    assert all(0 <= r["score"] <= 1 for r in out.collect())


def test_conflicting_null_and_repeated_labels(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (4, 7, 0), (5, 0, None)]
    got = discriminant.labels_of(spark.createDataFrame(rows, LABELS))
    assert as_rows(got, "doc_id", "label") == [(2, 1), (5, 0)]


def test_odd_rows(spark, frame, docs):
    _, _, labels = table(spark, 300)
    more = spark.createDataFrame([(None, "no id", None, None, None), (7, None, None, None, None)], DOCS)
    out = discriminant.classify(clashing(frame.unionAll(more).unionAll(more)), labels).collect()
    assert len(out) == len(docs) + 4 and all(0 <= r["score"] <= 1 for r in out)
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False, False]
    empty = {r["score"] for r in out if r["doc_id"] in {i for i, t, *_ in docs if not (t or "").strip(" ")}}
    assert len(empty) == 1
    nothing = discriminant.classify(spark.createDataFrame([], DOCS), labels)
    assert nothing.count() == 0 and nothing.columns == ["doc_id", "held_out", "score", "predicted"]
