import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import DOCS, as_rows, clashing
from tidelog.llm import phrases

OUT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=5, least=100, share=100, top=2000):
    count, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in count.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {
            p[x:y] for p, a in found.items() for x in range(len(p)) for y in range(x + 2, len(p) + 1)
            if y - x < len(p) and 100 * a >= share * found[p[x:y]]
        }
        rows = []
        for p, a in found.items():
            if p not in gone:
                cuts = ((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                score, k = min(cuts)
                rows.append((" ".join(p), a, c[p[:k]], c[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:top])]
    return sorted(out, key=repr)


def texts(n=400, seed=8):
    rng = random.Random(seed)
    some = ["the", "The", "cat", "sat", "on", "a", "mat", "é", "ß-x", "漢字", "x y", "\U0001f600", "it's"]
    rows = []
    for i in range(n):
        w = [rng.choice(some) for _ in range(rng.randint(0, 40))]
        for k in range(len(w)):
            if rng.random() < 0.15:
                w[k] += rng.choice([".", ",", ";", ":", "!", "?", "\n", "\r\n", "\x0b", "\x0c", " ...  "])
        if i % 3 == 0:
            w += "in other Words as it were".split()
        rows.append((rng.choice([" ", "  ", "\t"]).join(w), ("en", "de", None, "und")[i % 4]))
    return [*rows, (None, "en"), ("", None), (" ,;\n", "fr"), ("one two", "es"), ("same same " * 200, "it")]


def frame(spark, rows):
    return spark.createDataFrame([(i % 7 or None, t, lang, None, 0) for i, (t, lang) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("least", [100, 7])
def test_equals_brute_force(spark, least):
    rows = texts()
    got = phrases.mine(clashing(frame(spark, rows).repartition(4)), least=least)
    want = brute(rows, least=least)
    assert as_rows(got, *OUT) == want and len(want) > (10 if least < 100 else 3)


@pytest.mark.parametrize("chunk,held,piece", [(3, 5, 4), (50, 200, 64), (7, 10_000, 4 << 20)])
def test_any_cut_gives_the_same(spark, monkeypatch, chunk, held, piece):
    """Chunks end inside pieces, and texts are split inside words' neighbourhoods."""
    rows = texts(60)
    for name, value in (("CHUNK", chunk), ("HELD", held), ("PIECE", piece), ("ROWS", 2)):
        monkeypatch.setattr(phrases, name, value)
    assert as_rows(phrases.mine(frame(spark, rows), least=4), *OUT) == brute(rows, least=4)


def test_very_long_text_and_words(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 5000)
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "x" * 70]) for _ in range(60_000))
    rows = [(long, "en"), ("w" * 3_000_000, "en"), (long[:1000], "en")]
    assert as_rows(phrases.mine(frame(spark, rows)), *OUT) == brute(rows)


def test_top_ties_and_share(spark):
    rows = texts(200)
    for top, share in ((3, 100), (2000, 60)):
        got = phrases.mine(frame(spark, rows), least=5, top=top, share=share)
        assert as_rows(got, *OUT) == brute(rows, least=5, top=top, share=share)


def test_shorter_phrases_only(spark):
    rows = texts(150)
    assert as_rows(phrases.mine(frame(spark, rows), longest=2, least=5), *OUT) == brute(rows, longest=2, least=5)


def test_nothing_frequent(spark):
    for rows in ([], [(None, None)], [("a b c", "en")]):
        assert phrases.mine(spark.createDataFrame([(1, t, x, None, 0) for t, x in rows], DOCS)).count() == 0


def test_products_past_64_bits(spark):
    """Counts near 2**40 score exactly."""
    big = (1 << 40) - 87
    words = [("en", ["a"], big), ("en", ["b"], big - 5), ("en", ["a", "b"], big - 11)]
    found = spark.createDataFrame(words, "lang string, words array<string>, f long")
    sizes = spark.createDataFrame([("en", (1 << 45) - 1)], "lang string, n long")
    got = phrases.scores(found, sizes).first()
    assert got["score"] == 1000 * (big - 11) * ((1 << 45) - 1) // (big * (big - 5))


def test_rare_pairs_travel_packed(spark, monkeypatch):
    """Pairs that occur once or twice don't cost a row each, and many ranges change nothing."""
    monkeypatch.setattr(phrases, "RANGE", 1 << 10)
    rng = random.Random(4)
    some = [f"w{i}" for i in range(150)]
    rows = [(" ".join(rng.choice(some) for _ in range(50)), "en") for _ in range(400)]
    rows += [("w1 w2 w3 w4", "en")] * 40
    n, labels = [], []
    plain = phrases.landed
    monkeypatch.setattr(phrases, "landed", lambda df, label: (n.append(df.count()), labels.append(label)) and plain(df, label))
    got = phrases.mine(frame(spark, rows).repartition(3), least=30)
    assert as_rows(got, *OUT) == brute(rows, least=30)
    pairs = [x for x, label in zip(n, labels, strict=True) if label == "occurrences"][1]
    assert 3 < pairs < 100


@pytest.mark.parametrize("numbers", [[], [0], [255, 256, 0], [1 << 40, 3, (1 << 62) + 7], list(range(1000))])
def test_packed_numbers_come_back(numbers):
    numbers = phrases.np.array(numbers, "int64")
    assert phrases._unpack(phrases._pack(numbers)).tolist() == numbers.tolist()
    assert phrases._unpack_sorted(phrases._pack_sorted(phrases.np.sort(numbers))).tolist() == sorted(numbers.tolist())
