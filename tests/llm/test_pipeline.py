import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCS, as_rows, clashing, words

SF = "/root/testdata/sf0.001"


def corpus(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rng = random.Random(6)
    rows = [(i, words(rng, 60), "en", f"s{i % 4}", 0) for i in range(200)]
    rows[50] = (50, rows[3][1] + " tail", "en", "s2", 0)
    rows[60] = (60, rows[60][1] + " " + item, "en", "s0", 0)
    rows[70] = (70, "é " + rows[70][1] + ' token = "abcdefgh12345678" end', "en", "s2", 77)
    rows[80] = (80, "too short", "en", "s0", 0)
    rows[90] = (90, " ".join(w + "###" for w in rows[90][1].split()), "en", "s2", 0)
    return [*rows, (None, None, None, None, None), (None, words(rng, 30), None, None, 5)]


def test_stages_take_effect_and_keep_clean_documents(spark):
    rows = corpus(spark)
    docs = clashing(spark.createDataFrame(rows, DOCS).repartition(3))
    ids = {r[0] for r in rows}
    for gone, (name, stage) in zip(({80, 90}, {50}, {60}, set()), corpus_pipeline.STAGES[:-1], strict=True):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
        ids -= gone
        docs = corpus_pipeline.landed(out, "t")
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} == ids, name
        # Rows without an id are judged by their own text: the one without text goes.
        assert docs.filter("doc_id is null").count() == 1
    clean = docs.filter("doc_id = 70").first()
    assert clean["text"].endswith('[assign]" end') and clean["n_chars"] == len(clean["text"])
    kept = {r[0]: r[1] for r in rows}
    assert all(r["text"] == kept[r["doc_id"]] for r in docs.filter("doc_id <> 70").collect())
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.columns[:-1] == docs.columns and mixed.agg(F.max(mixed.columns[-1])).first()[0] <= 2


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.landed(stage(spark, docs, SF), "t")
    assert as_rows(corpus_pipeline.run(spark, SF), "doc_id", "copy") == as_rows(docs, "doc_id", "copy")


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_rows_without_an_id_and_with_the_same_id_are_each_judged(spark):
    """A mix of rows that all lack an id comes near its target; one good row saves no other."""
    rng = random.Random(3)
    texts = [words(rng, rng.randint(20, 60)) for _ in range(3000)]
    rows = [(None, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    n = mixed.select(F.sum(F.size(F.split("text", " "))).alias("n")).first()["n"]
    total = sum(len(t.split()) for t in texts)
    assert abs(n - 1.5 * total) < 0.01 * total
    again = corpus_pipeline.mix_sources(spark, docs.repartition(7), SF)
    assert as_rows(mixed, "text", "copy") == as_rows(again, "text", "copy")
    same = [(7, texts[0], "en", "s0", 0), (7, "short", "en", "s0", 0), (7, " ".join(f"{w}###" for w in texts[1].split()), "en", "s0", 0)]
    judged = corpus_pipeline.quality_rules(spark, spark.createDataFrame(rows[:200] + same, DOCS), SF)
    assert [r["text"] for r in judged.filter("doc_id = 7").collect()] == [texts[0]]
    copies = [(None, texts[5], None, None, 0)] * 3 + [(9, texts[6], None, None, 0), (8, texts[6], "x", None, 0), (9, texts[7], None, None, 0)]
    left = corpus_pipeline.near_dedup(spark, spark.createDataFrame(copies, DOCS), SF)
    assert as_rows(left, "doc_id", "text") == sorted([(None, texts[5]), (8, texts[6]), (9, texts[7])], key=repr)


def test_a_very_long_text_passes_all_stages(spark):
    rng = random.Random(4)
    long = words(rng, 60_000)
    rows = [(i, words(rng, 50), "en", "s", 0) for i in range(60)] + [(99, long + " token=abcdefgh1234 end", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.landed(stage(spark, docs, SF), "t")
    assert docs.count() == 61 and docs.filter("doc_id = 99").first()["text"] == long + " [assign] end"


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_copies_at_80_to_85_percent_go(spark):
    rng = random.Random(9)
    rows, gone, between = [], set(), 0
    for k in range(60):
        base = words(rng, 30 + k).split()
        copy = list(base)
        # A changed word inside a text changes five shingles of it.
        copy[len(base) // 2] = f"edit{k}"
        if len(base) > 70:
            copy[len(base) // 4] = f"more{k}"
        rows += [(2 * k, " ".join(base), "en", "s", 0), (2 * k + 1, " ".join(copy), "en", "s", 0)]
        p, q = shingles(rows[-2][1]), shingles(rows[-1][1])
        if 100 * len(p & q) >= 80 * len(p | q):
            gone.add(2 * k + 1)
            between += 100 * len(p & q) < 85 * len(p | q)
    assert between >= 10 and len(gone) < 60
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), SF)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r[0] for r in rows} - gone
