import random

import pytest

from tests.llm.conftest import DOCS, as_rows, clashing, words
from tidelog.llm import neardup
from tidelog.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    ids = [d[0] for d in docs]
    sets = [shingles(d[1]) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return sorted((ids[i], len(sets[i]), ids[find(i)], find(i) == i) for i in range(len(docs)))


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_equals_brute_force(frame, docs):
    assert as_rows(neardup.link(clashing(frame)), *COLUMNS) == sorted(brute(docs), key=repr)


def test_chains_and_large_groups(spark):
    """Each of a chain is linked to the next alone; a group has many different near copies."""
    rng = random.Random(3)
    w = words(rng, 150).split()
    texts = []
    for k in range(40):
        texts.append(" ".join(w))
        w[(k * 7) % 150] = f"chain{k}"
    base = words(rng, 120).split()
    for k in range(80):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(120)] = f"e{k}{rng.random()}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    docs = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    got = as_rows(neardup.link(spark.createDataFrame(docs, DOCS)), *COLUMNS)
    assert got == sorted(brute(docs), key=repr)


def test_empty_null_and_repeated(spark):
    assert neardup.link(spark.createDataFrame([], DOCS)).count() == 0
    text = "a b c d e f g h"
    rows = [(None, text, None, None, None), (4, text, None, None, None), (4, text, None, None, None),
            (9, None, None, None, None), (8, " ", None, None, None), (2, text.upper(), None, None, None)]
    got = as_rows(neardup.link(spark.createDataFrame(rows, DOCS)), *COLUMNS)
    assert got == sorted(
        [(None, 4, None, True), (4, 4, 2, False), (4, 4, 2, False), (9, 0, 9, True), (8, 0, 8, True), (2, 4, 2, True)],
        key=repr,
    )


def test_sketches_tell_high_similarity():
    rng = random.Random(1)
    base = words(rng, 400).split()
    near, far = list(base), words(rng, 400).split()
    near[7] = "x"
    a, b, c = (neardup.odd_sketch(neardup.min_hashes(s)) for s in neardup.shingle_sets([" ".join(t) for t in (base, near, far)]))
    apart = lambda x, y: sum(bin(int(p) & (2**64 - 1)).count("1") for p in x ^ y)
    assert apart(a, b) < 20 and apart(a, c) > neardup.FAR


def turns(monkeypatch):
    """How often edges are landed, once per turn and once before."""
    from tidelog.llm import components as module

    seen = []
    plain = module.landed
    monkeypatch.setattr(module, "landed", lambda df, label: seen.append(label) or plain(df, label))
    return lambda: seen.count("edges") - 1


def unlucky(n):
    """A path whose least ids lie in turn at either end, so labels travel its whole length."""
    left, right = list(range(0, n, 2)), list(range(1, n, 2))
    return left + right[::-1]


@pytest.mark.parametrize("order", ["sorted", "unlucky", "random"])
def test_components_of_a_path_in_few_turns(spark, monkeypatch, order):
    n = 2000
    path = {"sorted": list(range(n)), "unlucky": unlucky(n), "random": random.Random(1).sample(range(n), n)}[order]
    edges = spark.createDataFrame([*zip(path, path[1:]), (n + 5, n + 9), (n + 9, n + 9)], "a long, b long")
    count = turns(monkeypatch)
    got = dict(as_rows(components(edges), "v", "c"))
    assert got == {**{i: 0 for i in range(n)}, n + 5: n + 5, n + 9: n + 5}
    assert count() <= 20


def test_components_of_stars_cliques_and_nothing(spark):
    rng = random.Random(2)
    edges = [(500, i) for i in range(100, 180)] + [(i, j) for i in range(20) for j in range(i)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for x, y in edges:
        a, b = find(x), find(y)
        root[max(a, b)] = min(a, b)
    got = dict(as_rows(components(spark.createDataFrame(edges, "a long, b long")), "v", "c"))
    assert got == {v: find(v) for e in edges for v in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_families_that_share_differences(spark, monkeypatch):
    """Two large families with a common passage in the same buckets: rows are linear."""
    rng = random.Random(9)
    common, one, two = words(rng, 260), words(rng, 60), words(rng, 60)
    texts = []
    for k in range(300):
        own = (one if k % 2 else two).split()
        own[rng.randrange(60)] = f"x{k}"
        texts.append(f"{common} {' '.join(own)}")
    rng.shuffle(texts)
    docs = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    sizes = []
    plain = neardup.confirm
    monkeypatch.setattr(neardup, "confirm", lambda pairs, *a: sizes.append(pairs.count()) or plain(pairs, *a))
    got = as_rows(neardup.link(spark.createDataFrame(docs, DOCS)), *COLUMNS)
    assert got == sorted(brute(docs), key=repr)
    assert sum(sizes) < 20 * len(docs)


def test_small_tables_of_edges_take_few_tasks(spark, monkeypatch):
    """Turns don't take as many tasks as a shuffle of documents does."""
    from tidelog.llm import components as module

    parts = []
    plain = module.landed
    monkeypatch.setattr(module, "landed", lambda df, label: parts.append(df.rdd.getNumPartitions()) or plain(df, label))
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
        assert {c for _, c in as_rows(components(edges), "v", "c")} == {0}
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert len(parts) > 4 and max(parts[1:]) <= max(spark.sparkContext.defaultParallelism, 1)


def test_labels_take_further_edges_between_components(spark, monkeypatch):
    """Links found later are worked on by themselves, not together with all earlier ones."""
    from tidelog.llm import components as module

    edges = [(i, i + 1) for i in range(10, 90) if i % 10 < 9]
    labels = module.landed(components(spark.createDataFrame(edges, "a long, b long")), "labels")
    rows = []
    plain = module.landed
    monkeypatch.setattr(module, "landed", lambda df, label: rows.append((label, df.count())) or plain(df, label))
    more = [(20, 10), (30, 20), (70, 5), (200, 300), (60, 300)]
    got = dict(as_rows(module.merged(labels, spark.createDataFrame(more, "ca long, cb long")), "v", "c"))
    want = {v: {1: 10, 2: 10, 3: 10, 7: 5, 6: 60}.get(v // 10, v // 10 * 10) for v in range(10, 90)}
    assert got == want | {5: 5, 200: 60, 300: 60}
    assert max(n for label, n in rows if label == "edges") <= len(more)
