import random

import pytest

from tests.llm.conftest import DOCS, as_rows, clashing, words
from tidelog.llm import substring


def brute(docs):
    split = [(d[0], (d[1] or "").encode().split()) for d in docs]
    owner = {}
    for i, w in split:
        for k in range(len(w) - 12):
            x = tuple(w[k : k + 13])
            if i is not None:
                owner[x] = min(owner.get(x, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and owner[tuple(w[k : k + 13])] < i or i is None and tuple(w[k : k + 13]) in owner:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_removed", "text")


@pytest.mark.parametrize("chunk", [200, 4 << 20])
def test_equals_brute_force(frame, docs, monkeypatch, chunk):
    monkeypatch.setattr(substring, "CHUNK", chunk)
    assert as_rows(substring.dedup(clashing(frame)), *COLUMNS) == brute(docs)


@pytest.mark.parametrize("fan, levels", [(2, 5), (3, 3), (30, 1)])
def test_equals_brute_force_over_several_levels(frame, docs, monkeypatch, fan, levels):
    size = sum(len((d[1] or "").encode()) for d in docs)
    monkeypatch.setattr(substring, "FAN", fan)
    monkeypatch.setattr(substring, "CHUNK", size // 50)
    monkeypatch.setattr(substring, "RANGE", size // 20)
    assert substring.Route.over(21).levels == levels
    assert as_rows(substring.dedup(clashing(frame)), *COLUMNS) == brute(docs)


@pytest.mark.parametrize("n_ranges", [1, 10, 100, 1_000, 65_536, 6_000_000])
def test_pieces_do_not_grow_with_the_ranges(n_ranges):
    """A sender has at most FAN pieces at each level, and the blocks of a level are as many as
    the ranges asked for, or a little more."""
    import numpy as np

    route = substring.Route.over(n_ranges)
    assert n_ranges <= route.fan**route.levels <= max(1, 1.3 * n_ranges) or route.levels > 1
    assert route.fan <= substring.FAN
    hashes = np.unique(np.random.default_rng(3).integers(0, 1 << 48, 100_000).astype(np.uint64))
    block, held = None, hashes
    for level in range(1, route.levels + 1):
        group = route.group_of(77) if level == 1 else route.parent(block, level - 1)
        sent = substring.pieces(route, level, 0, group, held, np.zeros(len(held), np.int64), substring.ANCHOR_BITS)
        assert len(sent) <= substring.FAN
        got = [substring._unpacked(r["hashes"], r["base"], r["extra"])[0] for r in sent]
        assert (np.concatenate(got) == held).all()
        block, held = sent[0]["block"], got[0]
    # At the last level there is one group: the block's number is its range.
    assert block == route.ranges_of(held[:1], substring.ANCHOR_BITS, route.levels)[0]


def test_shared_passages_at_any_offset(spark, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 500)
    rng = random.Random(8)
    passage = words(rng, 20)
    rows = []
    for k in range(40):
        n = rng.choice((12, 13, 14, 20))
        piece = " ".join(passage.split()[:n])
        rows.append((1000 - k, words(rng, k) + " " + piece + " " + words(rng, rng.randint(0, 9)), "", "", 0))
    got = as_rows(substring.dedup(spark.createDataFrame(rows, DOCS).repartition(7)), *COLUMNS)
    assert got == brute(rows) and sum(r[2] for r in got) > 300


def test_null_ids_repeats_and_empty(spark):
    assert substring.dedup(spark.createDataFrame([], DOCS)).count() == 0
    text = " ".join(f"w{i}" for i in range(15))
    rows = [(None, text, None, None, None), (5, text, None, None, None), (5, text, None, None, None),
            (6, "a " + text, None, None, None), (7, None, None, None, None)]
    assert as_rows(substring.dedup(spark.createDataFrame(rows, DOCS)), *COLUMNS) == brute(rows)


def test_cover_reaches_every_pair_of_positions():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any(
                (i + d) % substring.PERIOD in substring.COVER and (j + d) % substring.PERIOD in substring.COVER
                for d in range(substring.PERIOD)
            )
