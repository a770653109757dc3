import random

import numpy as np

from tests.llm.conftest import DOCS, as_rows, clashing, words
from tidelog.llm import decontam

ITEMS = "item_id long, text string"


def corpus():
    rng = random.Random(11)
    items = [(i, words(rng, rng.randint(10, 130)) + " the of and") for i in range(60)]
    items[5] = (5, "What is the capital of Freedonia in the old film? The city of Glorious Sylvania Heights")
    docs, want = [], set()
    for d in range(150):
        text = words(rng, rng.randint(0, 400)) + " the of and the"
        if d % 5 == 0:
            i, t = items[(d * 7) % 60]
            t = t.upper() if d % 2 else t.replace(" ", "  \n")
            text = words(rng, rng.randint(0, 150)) + " " + t + ". " + words(rng, 20)
            want.add((d, i))
        docs.append((d, text, "", "", 0))
    docs.append((500, words(rng, 60_000) + " " + items[3][1], "", "", 0))
    want.add((500, 3))
    return items, docs, want


def test_planted_items_are_found(spark):
    items, docs, want = corpus()
    benchmark = clashing(spark.createDataFrame([*items, (900, None), (901, "  "), (902, "?!")], ITEMS))
    out = decontam.contaminated(clashing(spark.createDataFrame(docs, DOCS).repartition(4)), benchmark)
    assert set(as_rows(out, "doc_id", "item_id")) == want


def test_question_alone_is_no_leak(spark):
    items, _, _ = corpus()
    rng = random.Random(2)
    question = items[5][1].split("?")[0]
    docs = [(1, words(rng, 30) + " " + question + " " + words(rng, 30), "", "", 0), (2, items[5][1], "", "", 0)]
    out = decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert as_rows(out, "doc_id", "item_id") == [(2, 5)]


def test_most_of_an_item_without_a_question_is_a_leak():
    items, _, _ = corpus()
    rng = random.Random(4)
    index = decontam.Index(items)
    for i, text in items[:20]:
        own = text.split()
        part = " ".join(own[: len(own) * 3 // 4])
        found = list(index.matches(decontam.words_of([f"{words(rng, 30)} {part} {words(rng, 30)}", words(rng, 60)])))
        # Three quarters hold the question of item 5, which has one, and not its answer.
        assert [(m[0], m[1]) for m in found if m[1] != 5] == ([] if i == 5 else [(0, i)])


def test_wand_equals_all_scores():
    items, docs, _ = corpus()
    index = decontam.Index(items)
    rng = random.Random(3)
    vocabulary = [w for _, t in items for w in t.split()]
    for k in range(80):
        own = items[k % 60][1].split()
        text = " ".join(rng.sample(vocabulary, 40) + own[: rng.randint(0, len(own))])
        terms = index.codes(decontam.Words([text], decontam.normal).hashes)
        terms = np.unique(terms[terms >= 0])
        score = np.zeros(index.n_entries)
        for t in terms:
            a, b = index.first[t], index.first[t + 1]
            score[index.entry[a:b]] += index.impact[a:b]
        want = [(e, round(s, 9)) for e, s in enumerate(score) if s >= decontam.THRESHOLD - 1e-9]
        assert [(e, round(s, 9)) for e, s in index.wand(terms)] == want
        # The bounds never refuse a passage that has an entry.
        one = np.zeros(len(terms), np.int64)
        assert len(index.bound(one, terms, 1, True, decontam.THRESHOLD - 1e-9)) == bool(want)
        _, essential = index.essentials(decontam.Words([text], decontam.normal).hashes)
        essential = np.unique(essential)
        if want:
            assert len(index.bound(np.zeros(len(essential), np.int64), essential, 1, False, index.rest))


def test_shards_give_the_same(spark, monkeypatch):
    items, docs, want = corpus()
    monkeypatch.setattr(decontam, "SHARD", 40)
    out = decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert set(as_rows(out, "doc_id", "item_id")) == want


def test_scores_of_partial_leaks_do_not_depend_on_shards(spark, monkeypatch):
    items, _, _ = corpus()
    rng = random.Random(8)
    docs = []
    for i, text in items:
        own = text.split()
        docs.append((i, " ".join(own[: len(own) * (50 + i % 40) // 100]) + " " + words(rng, 50), "", "", 0))
    out = {}
    for size in (20_000, 40):
        monkeypatch.setattr(decontam, "SHARD", size)
        found = decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
        out[size] = sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in found.collect())
    assert out[20_000] == out[40] and len(out[40]) > 20
    assert any(score < 0.95 for _, _, score in out[40])


def test_empty_null_and_repeated(spark):
    items, _, _ = corpus()
    benchmark = spark.createDataFrame(items, ITEMS)
    assert decontam.contaminated(spark.createDataFrame([], DOCS), benchmark).count() == 0
    docs = spark.createDataFrame([(None, None, "", "", 0), (1, "", "", "", 0), (2, items[0][1], "", "", 0), (2, items[0][1], "", "", 0)], DOCS)
    assert decontam.contaminated(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert as_rows(decontam.contaminated(docs, benchmark), "doc_id", "item_id") == [(2, 0), (2, 0)]


def test_short_items_must_stand_word_for_word(spark):
    texts = ["the man who saw me yesterday at the market in town", "He asked: who, ME? And left.", "who me", "me who"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    items = spark.createDataFrame([(1, "Who? Me"), (2, "one two three four five six seven")], "item_id long, text string")
    out = decontam.contaminated(docs, items)
    assert as_rows(out, "doc_id", "item_id") == [(1, 1), (2, 1)]


def test_nothing_of_the_benchmark_comes_to_the_driver():
    import inspect

    code = inspect.getsource(decontam)
    assert ".collect(" not in code and ".toArrow(" not in code and "broadcast(" not in code
