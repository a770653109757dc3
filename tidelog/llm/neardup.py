"""Near duplicates by MinHash bands, verified first by odd sketches and then in full.

A document is its set of distinct 5-word shingles. Documents with equal sets are one class.
Of each class, MinHash values are taken: in bands they name buckets in which similar
classes meet, and folded into a parity bitmap (an odd sketch) they tell, by the number of
bits in which two sketches differ, how similar two classes are.

Classes of a bucket aren't all paired. Each meets its bucket's leader, the class that shares
most buckets with most others; sketches drop the unlike, full sets confirm a link, and
components follow. What then is still apart in a bucket is compared by differences from the
leader's set: a class that isn't linked with the leader can only be linked with another of
the bucket if a certain number of differences is the same in both, so it is enough to join
prefixes of their sorted differences (see ``_differences``). Where many classes share a
difference, each meets one of them first; what then is still apart is joined by components,
so a large family that is one component already counts as one row per shared difference. A
link inside a component changes no component, so nothing is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Words, landed, lower_ascii, mix, slices, text_of, window_hashes
from tidelog.llm.components import components, merged

SHINGLE = 5
#: Rows of a band. Bands and samples follow from the threshold, see ``Plan``.
ROWS = 4
#: Most a linked pair may be missed for want of a common band, and by its sketches.
MISS, MISS_SKETCH = 4e-7, 2e-7


class Plan:
    """What follows from a threshold: 100 * intersection >= link * union links two sets.

    ``bands`` is the least number of bands of ROWS with which a pair at the threshold shares
    none with probability MISS at most: (1 - (link / 100)**ROWS)**bands. A differing sample
    turns two bits of an odd sketch at most, so a pair with up to d differing samples differs
    in up to 2 * d = ``far`` bits; a pair at the threshold has more than d with probability
    MISS_SKETCH at most. The sketch is at least twice as long as there are samples, so that
    unlike sets stay beyond ``far``. 85: 20 bands, 60 of 256 bits. 80: 28 bands, 92 of 512.
    """

    def __init__(self, link: int):
        if not 50 <= link <= 100:
            raise ValueError(f"threshold {link} is not in 50 .. 100 percent")
        self.link, alike = link, link / 100
        self.bands = 1
        while (1 - alike**ROWS) ** self.bands > MISS:
            self.bands += 1
        n = self.samples = self.bands * ROWS
        least, more = 0, 1 - alike**n
        while more > MISS_SKETCH:
            least += 1
            more -= math.comb(n, least) * (1 - alike) ** least * alike ** (n - least)
        self.far = 2 * least
        self.bits = max(256, 1 << (2 * n - 1).bit_length())
        rng = np.random.RandomState(31337)
        draw = lambda: rng.randint(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        self.factor = draw() * np.uint64(2) + np.uint64(1)
        self.add = draw()
        self.sketch = [f"s{i}" for i in range(self.bits // 64)]


#: The threshold of ``link`` where none is given, and its far.
LINK = 85
OWN = Plan(LINK)
FAR = OWN.far


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, lower_ascii)
    sets = []
    for i in range(len(texts)):
        words = w.hashes[w.at[i] : w.at[i + 1]]
        sets.append(np.unique(window_hashes(words, min(SHINGLE, len(words)))) if len(words) else words)
    return sets


def min_hashes(values: np.ndarray, plan: Plan = OWN) -> np.ndarray:
    best = np.full(plan.samples, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(values), 4096):
            part = values[a : a + 4096, None] * plan.factor + plan.add
            best = np.minimum(best, part.min(axis=0))
    return best


def band_keys(samples: np.ndarray, plan: Plan = OWN) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(1, plan.bands + 1, dtype=np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples.reshape(plan.bands, ROWS)[:, r])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray, plan: Plan = OWN) -> np.ndarray:
    """Parity of the number of samples that hash to each bit, as 64-bit words."""
    with np.errstate(over="ignore"):
        place = mix(samples + np.arange(plan.samples, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) % np.uint64(plan.bits)
    parity = np.bincount(place.astype(np.int64), minlength=plan.bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _sketches(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in slices(texts):
            sets = shingle_sets(texts[a:b])
            n = np.array([len(s) for s in sets], np.int64)
            samples = [min_hashes(s, plan) for s in sets]
            bands = np.concatenate([band_keys(m, plan) for m in samples])
            words = np.array([odd_sketch(m, plan) for m in samples]).reshape(-1, len(plan.sketch))
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            at = np.arange(0, len(bands) + 1, plan.bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(n), pa.array(names, pa.binary()),
                 *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(len(plan.sketch))],
                 pa.ListArray.from_arrays(pa.array(at), pa.array(bands))],
                ["doc_id", "n_shingles", "name", *plan.sketch, "bands"],
            )


def sketches(docs: DataFrame, key: str = "doc_id", plan: Plan = OWN) -> DataFrame:
    """Per row: set size, name of the set, sketch and band keys."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), text_of("text").alias("text"))
    schema = "doc_id long, n_shingles long, name binary, " + ", ".join(f"{s} long" for s in plan.sketch)
    return own.mapInArrow(partial(_sketches, plan), schema + ", bands array<long>")


def _apart(left: str, right: str, plan: Plan):
    """Bits in which two sketches differ."""
    total = F.lit(0)
    for s in plan.sketch:
        total = total + F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")))
    return total


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of each row's two texts. Rows of one leader follow each other, so its set is
    computed once; no more than three sets are held at a time."""
    left, right, ids = (batch.column(c).to_pylist() for c in ("ta", "tb", "b"))
    last, lead = None, None
    for x, y, b in zip(left, right, ids, strict=True):
        if lead is None or b != last:
            last, lead = b, shingle_sets([y])[0]
        yield shingle_sets([x])[0], lead


def _linked(link: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (p, q) in enumerate(_sets(batch)):
            # Sets of these sizes may be too different whatever they share.
            if 100 * min(len(p), len(q)) < link * max(len(p), len(q)):
                continue
            both = np.concatenate([p, q])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= link * (len(both) - common):
                keep.append(i)
        if keep:
            yield batch.drop_columns(["ta", "tb"]).take(pa.array(keep))


DIFFERENCE = "leader long, v long, c long, element long, rest long, t double, u double, short boolean"


def _differences(link: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What of a class (a) differs from its bucket's leader (b), as far as it is needed.

    Let a class x lack p of the leader's n shingles and have q others. Two classes x and y
    of a leader share n - p_x - p_y + s shingles, s being the number of differences that are
    the same in both. With r = link / (100 + link), they are linked if that reaches
    r * (|x| + |y|), so if

        s >= t(x) + u(y),  t(x) = p_x - n + r * (|x| + n),  u(y) = (1 - r) * p_y + r * q_y

    and t(x) > 0 just if x isn't linked with the leader. So one of two classes that are
    linked but not through the leader has s >= t(x) > 0 and the other s > u(y). If both
    lists of differences are sorted alike, those prefixes that leave out less than that many
    share an element. At the first one they share, ``rest`` of each list, this one counted,
    can still be the same: it must reach t(x) + u(y). Added shingles come first: they are
    rare.
    """
    r = link / (100 + link)
    for batch in batches:
        for i, (own, lead) in enumerate(_sets(batch)):
            added, lacked = np.setdiff1d(own, lead, True), np.setdiff1d(lead, own, True)
            p, q, n = len(lacked), len(added), len(lead)
            # A small allowance for rounding only lets more pairs through.
            t = p - n + r * (len(own) + n) - 1e-6
            u = (1 - r) * p + r * q - 1e-6
            unlinked = 100 * (n - p) < link * (n + q)
            elements = np.concatenate([added, mix(lacked + np.uint64(1))]).view(np.int64)
            x_length = p + q - max(1, int(np.ceil(t))) + 1 if unlinked else 0
            y_length = max(0, p + q - (int(np.floor(u)) + 1) + 1)
            size = max(x_length, y_length)
            at = np.arange(size)
            same = lambda name, k=i, m=size: pa.array([batch.column(name)[k].as_py()] * m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [same("b"), same("a"), same("c"), pa.array(elements[:size]), pa.array(p + q - at),
                 pa.array(np.full(size, t), mask=at >= x_length), pa.array(np.full(size, u)), pa.array(at < y_length)],
                ["leader", "v", "c", "element", "rest", "t", "u", "short"],
            )


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(first, "a").join(second, "b")


def confirm(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Those pairs (a, b) that are linked by their full sets; their other columns are numbers
    and stay. ``texts``: (doc_id, text)."""
    full = _with_texts(pairs, texts).select(*pairs.columns, "ta", "tb")
    schema = ", ".join(f"{c} long" for c in pairs.columns)
    return landed(full.mapInArrow(partial(_linked, threshold), schema), "links")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components ca and cb of their ends; an end without label is its own."""
    for end in ("a", "b"):
        one = labels.select(F.col("v").alias(end), F.col("c").alias(f"_c{end}"))
        pairs = pairs.join(one, end, "left").withColumn(f"c{end}", F.coalesce(f"_c{end}", end)).drop(f"_c{end}")
    return pairs


_PLACE = ["leader", "element"]


def _with_component(unlike: DataFrame, labels: DataFrame) -> DataFrame:
    """Differences with their class's component ``c``."""
    found = labels.select("v", F.col("c").alias("_c"))
    return unlike.join(found, "v", "left").withColumn("c", F.coalesce("_c", "v")).drop("_c")


def _sides(unlike: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that may be the one a link is found from (x), and the other one (y)."""
    x = unlike.filter("t is not null").select(*_PLACE, F.col("v").alias("a"), F.col("c").alias("ca"), F.col("rest").alias("ra"), "t")
    y = unlike.filter("short").select(*_PLACE, F.col("v").alias("b"), F.col("c").alias("cb"), F.col("rest").alias("rb"), "u")
    return x, y


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b, and the components of either."""
    one, other = F.struct("a", F.col("ca").alias("c")), F.struct(F.col("b").alias("a"), F.col("cb").alias("c"))
    both = found.select(F.least(one, other).alias("p"), F.greatest(one, other).alias("q"))
    return both.select(F.col("p.a").alias("a"), F.col("q.a").alias("b"), F.col("p.c").alias("ca"), F.col("q.c").alias("cb")).distinct()


def _with_one(unlike: DataFrame) -> DataFrame:
    """Where classes share a difference, each with the one that differs least: a row per class
    and difference."""
    x, y = _sides(unlike)
    one = y.groupBy(*_PLACE).agg(F.min(F.struct("u", "b", "cb", "rb")).alias("y")).select(*_PLACE, "y.*")
    return _pairs(x.join(one, _PLACE).filter("ca <> cb and least(ra, rb) >= t + u"))


def _between_components(unlike: DataFrame) -> DataFrame:
    """Classes of different components that share a difference and may be linked. Components
    are joined first, each with the best of its classes, so those that can't be linked, or
    have no other component beside them, are not spread out into their classes."""
    x, y = _sides(unlike)
    xs = x.groupBy(*_PLACE, "ca").agg(F.min("t").alias("t"), F.max("ra").alias("ra"))
    ys = y.groupBy(*_PLACE, "cb").agg(F.min("u").alias("u"), F.max("rb").alias("rb"))
    near = xs.join(ys, _PLACE).filter("ca <> cb and least(ra, rb) >= t + u").select(*_PLACE, "ca", "cb")
    near = landed(near, "near")
    found = near.join(x, [*_PLACE, "ca"]).join(y, [*_PLACE, "cb"]).filter("least(ra, rb) >= t + u")
    return _pairs(found)


def link(docs: DataFrame, key: str = "doc_id", threshold: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; sets whose similarity is
    ``threshold`` percent or more are linked.

    A text without words (or null) has an empty set and is linked with nothing. Rows with
    equal sets are linked; rows that repeat a doc_id count as one document, so what either
    is linked with, both are. Rows with null doc_id are linked with nothing, get a null
    component and stay. An empty table gives no row; other columns are not read.
    """
    plan = Plan(threshold)
    every = landed(sketches(docs, key, plan), "sketches")
    real = every.filter("name is not null and doc_id is not null")
    classes = real.groupBy("name").agg(
        F.min("doc_id").alias("v"), F.first(F.struct(*plan.sketch)).alias("sketch"), F.first("bands").alias("bands")
    )
    classes = landed(classes, "classes")
    rows = classes.select("v", "sketch", F.explode("bands").alias("bucket"))

    # Buckets of several classes, and each class with its bucket's leader.
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    rows = landed(rows.join(sizes, "bucket"), "rows")
    central = rows.groupBy("v").agg(F.sum("n").alias("central"))
    rows = rows.join(central, "v")
    first = F.min(F.struct(-F.col("central"), "v", "sketch")).alias("l")
    leaders = rows.groupBy("bucket").agg(first).select("bucket", F.col("l.v").alias("lv"), F.col("l.sketch").alias("ls"))
    led = rows.select("bucket", "v", "sketch", "n").join(leaders, "bucket").filter("v <> lv")
    led = led.withColumn("apart", _apart("sketch", "ls", plan)).drop("sketch", "ls")
    led = landed(led, "led")
    near = led.filter(F.col("apart") <= plan.far)
    pairs = near.groupBy("v", F.col("lv").alias("w")).agg(F.min("apart").alias("apart"))
    pairs = landed(pairs, "pairs")

    # The texts of all classes that share a bucket leave the table once.
    own = docs.select(F.col(key).cast("long").alias("doc_id"), text_of("text").alias("text"))
    texts = landed(own.join(central.select(F.col("v").alias("doc_id")), "doc_id", "left_semi"), "texts")

    # 1: each class with the leader it is nearest to.
    nearest = pairs.groupBy("v").agg(F.min(F.struct("apart", "w")).alias("m"))
    nearest = landed(nearest.select(F.col("v").alias("a"), F.col("m.w").alias("b")), "nearest")
    labels = components(confirm(nearest, texts, threshold))

    # 2: with its other leaders, where they are in other components.
    others = pairs.select(F.col("v").alias("a"), F.col("w").alias("b")).join(nearest, ["a", "b"], "left_anti")
    others = landed(_labelled(others, labels).filter("ca <> cb").select("a", "b", "ca", "cb"), "others")
    if not others.isEmpty():
        labels = merged(labels, confirm(others, texts, threshold))

    # 3: buckets of three classes or more that still hold several components.
    placed = _labelled(led.filter("n > 2").select(F.col("v").alias("a"), F.col("lv").alias("b"), "bucket"), labels)
    mixed = placed.filter("ca <> cb").select("bucket").distinct()
    again = placed.join(mixed, "bucket", "left_semi").select("a", "b", F.col("ca").alias("c")).distinct()
    again = landed(again, "again")
    if not again.isEmpty():
        unlike = landed(_with_texts(again, texts).mapInArrow(partial(_differences, threshold), DIFFERENCE), "differences")
        unlike = unlike.drop("c")
        for candidates in (_with_one, _between_components):
            left = landed(candidates(_with_component(unlike, labels)), "left")
            if not left.isEmpty():
                labels = merged(labels, confirm(left, texts, threshold))

    named = classes.join(labels.select("v", "c"), "v", "left").select("name", F.coalesce("c", "v").alias("component_id"))
    linked = real.join(named, "name").select("doc_id", "n_shingles", "component_id")
    alone = every.filter("name is null or doc_id is null")
    out = linked.unionAll(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
