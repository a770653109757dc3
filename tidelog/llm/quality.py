"""Quality rules: base counts, and robust multivariate outliers by language and source.

Each document is a vector of smoothed ratios, in units of the least standard deviation that
counts (``FLOOR``). For every (language, source), every language and the whole table the
minimum-covariance-determinant estimate is sought: the mean and covariance of those 75 % of
documents whose covariance (the floor's variance added) has the least determinant. From each
of three starts (medians with unit variances, medians with robust spreads, mean and
covariance of all) concentration steps keep the documents nearest to the centre and estimate
anew, until the determinant falls no further; of the three results the one of the least
determinant stands. An estimate then moves towards that of its parent (language, whole table)
as if ``SHARED`` documents more had the parent's, so verdicts pass smoothly from a group of
one document to a large one. A document is rejected if its Mahalanobis distance, scaled so
that the group's median is that of chi-squared, is too large.

All documents take part. A step is one aggregate over (group, start, binned distance): integer
sums, so results don't depend on the order in which tasks end. Vectors are whole numbers,
1/64 of a unit each. Beyond 256 units a component grows with the logarithm of the ratio, so
it has no bound, larger ratios stay larger, and its square still fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Words, landed, slices, text_of, window_hashes

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_letters", "n_upper", "n_other")

#: Ratio, and the least standard deviation of it that counts.
FLOOR = {
    "word length": 0.4,
    "symbols per word": 0.06,
    "repeated lines": 0.1,
    "repeated words": 0.06,
    "upper case": 0.03,
    "punctuation per word": 0.12,
}
P = len(FLOOR)
UNIT = 64
#: Where components begin to grow logarithmically: at 256 units.
LINEAR = 1 << 14
#: Share of documents the estimate rests on, bins per doubling of distance, starts.
KEPT_SHARE, BINS, STARTS = 0.75, 32, 3
#: Documents' worth of its parent in a group's estimate.
SHARED = 50
#: Median of chi-squared with P = 6 degrees of freedom, and the cut for its distances.
MEDIAN, CUT = 5.348, 20.0
#: Groups whose estimates (under 1 kB each) may be broadcast; more meet by a salted join.
BROADCAST_GROUPS, SALTS = 5_000, 64
#: Groups (and starts) that a task estimates. Each has a row per bin of its distances, some
#: hundreds, whatever the number of documents.
SOLVED = 32

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_OTHER = np.zeros(256, bool)
_OTHER[list(b"!\"'(),-./:;?@[\\]^_`{}~+=")] = True


def count(texts: list[str]) -> list[np.ndarray]:
    """The COUNTS of each text."""
    w = Words(texts)
    words = np.diff(w.at)
    # Sums over the bytes of each text, by differences of running sums.
    over = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.minimum(w.begin, len(w.raw))])
    raw = w.raw
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    chars = over(((raw & 0xC0) != 0x80) & ~space)
    repeats, duplicates, lines = [], [], []
    for i, text in enumerate(texts):
        h = window_hashes(w.hashes[w.at[i] : w.at[i + 1]], WINDOW)
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        step = np.zeros(words[i] + 1, np.int64)
        found = np.flatnonzero(times[inverse] > 1)
        np.add.at(step, found, 1)
        np.add.at(step, found + WINDOW, -1)
        repeats.append(int((np.cumsum(step) > 0).sum()))
        own = [x for x in text.encode().split(b"\n") if x.strip()]
        lines.append(len(own))
        duplicates.append(len(own) - len(set(own)))
    return [words, chars, over(_SYMBOL[raw]), np.array(duplicates), np.array(repeats), np.array(lines),
            over(upper | lower), over(upper), over(_OTHER[raw])]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in slices(texts):
            part = batch.slice(a, b - a)
            found = [pa.array(x.astype(np.int64)) for x in count(texts[a:b])]
            kept = [part.column(n) for n in ("doc_id", "lang", "source")]
            kept[1:] = [c.cast(pa.string()) for c in kept[1:]]
            yield pa.RecordBatch.from_arrays(kept + found, ["doc_id", "lang", "source", *COUNTS])


def statistics(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The counts of every whole text; null text has none."""
    own = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), text_of("text").alias("text"),
    )
    return own.mapInArrow(
        _count, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def _vector() -> list[Column]:
    """Smoothed ratios, so that a short text is no outlier for its shortness."""
    n = F.col("n_words") + 20
    ratios = [
        (F.col("word_chars") + 100) / n,
        F.col("n_symbols") / n,
        F.col("n_dup_lines") / (F.col("n_lines") + 5),
        F.col("n_repeat_words") / n,
        F.col("n_upper") / (F.col("n_letters") + 100),
        F.col("n_other") / n,
    ]
    scaled = [r / f * UNIT for r, f in zip(ratios, FLOOR.values(), strict=True)]
    grown = [F.when(x <= LINEAR, x).otherwise(LINEAR * (1 + F.log(x / LINEAR))) for x in scaled]
    return [F.round(x).cast("long").alias(f"q{i}") for i, x in enumerate(grown)]


def _keys() -> list[Column]:
    """Finest group first; JSON tells null from any text."""
    lang, source = F.col("lang"), F.col("source")
    return [
        F.concat(F.lit("2"), F.to_json(F.struct(lang, source))).alias("k2"),
        F.concat(F.lit("1"), F.to_json(F.struct(lang))).alias("k1"),
        F.lit("0").alias("k0"),
    ]


def _meet(rows: DataFrame, named: DataFrame, n_groups: int, key: str, how: str = "inner") -> DataFrame:
    """Rows with their group's estimates. Few are broadcast; many meet the rows by (group,
    salt), so that a hot group is dealt out."""
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(named), key, how)
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", (F.rand(7) * SALTS).cast("int")).join(salted, [key, "salt"], how).drop("salt")


def _distance(centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is the P x P matrix row by row."""
    d = [F.col(f"q{i}").cast("double") - centre[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + d[i] * d[j] * inverse[i * P + j] * (1.0 if i == j else 2.0)
    return F.greatest(F.lit(0.0), total)


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1.0) * BINS).cast("int")


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_ESTIMATE = "centre array<double>, cov array<double>, inverse array<double>, logdet double"
_GROUP = f"key string, start int, {_ESTIMATE}"


def _solved(key, start, mean: np.ndarray, cov: np.ndarray) -> tuple:
    """An estimate; ``cov`` has the floor's variance added."""
    return (key, start, mean.tolist(), cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1]))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["key", "start", "centre", "cov", "inverse", "logdet"])


def _few(groups: DataFrame, n_groups: int) -> DataFrame:
    """A table of groups in as many tasks as their number asks for, not that of documents."""
    return groups.coalesce(max(groups.sparkSession.sparkContext.defaultParallelism, n_groups // SOLVED + 1))


def _solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean and covariance per group and start. Sums are whole numbers, so nothing cancels."""
    for f in frames:
        out = []
        for r in f.itertuples(index=False):
            n, s = int(r.n), [int(getattr(r, f"s{i}")) for i in range(P)]
            cov = np.eye(P) * UNIT**2
            for i, j in _PAIRS:
                cov[i, j] += (int(getattr(r, f"s{i}_{j}")) * n - s[i] * s[j]) / n**2
                cov[j, i] = cov[i, j]
            out.append(_solved(r.key, r.start, np.array([x / n for x in s]), cov))
        yield _frame(out)


def _medians(rows: DataFrame) -> DataFrame:
    """Starts 0 and 1: medians (to 1/8 unit), with unit variances and with those that the
    middle half of the documents has."""
    long = rows.select(
        "key", F.posexplode(F.array(*[F.floor(F.col(f"q{i}") / 8).cast("long") for i in range(P)])).alias("i", "b")
    )
    bins = long.groupBy("key", "i", "b").agg(F.count("*").alias("n"))
    own = Window.partitionBy("key", "i")
    upto = own.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    seen, every = F.sum("n").over(upto), F.sum("n").over(own)
    bins = bins.withColumn("seen", seen / every)
    at = lambda share: F.min(F.when(F.col("seen") >= share, F.col("b"))) * 8.0 + 3.5
    one = bins.groupBy("key", "i").agg(at(0.5).alias("m"), (at(0.75) - at(0.25)).alias("spread"))
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("i", c))), lambda x: x[c])
    both = one.groupBy("key").agg(in_order("m").alias("m"), in_order("spread").alias("spread"))

    def starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                # The middle half of a normal distribution is 1.349 standard deviations wide.
                wide = np.diag((np.array(r.spread) / 1.349) ** 2 + UNIT**2)
                for start, cov in enumerate((np.eye(P) * float(UNIT**2), wide)):
                    out.append(_solved(r.key, start, np.array(r.m), cov))
            yield _frame(out)

    return both.mapInPandas(starts, _GROUP)


def _sums(rows: DataFrame, by: list[str]) -> DataFrame:
    """Count, sums and sums of products by group. A component is under 2**18 for any text, so
    a sum of products would pass 64 bits (and raise an error) with 2**27 such documents."""
    q = [F.col(f"q{i}") for i in range(P)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(q)]
    sums += [F.sum(q[i] * q[j]).alias(f"s{i}_{j}") for i, j in _PAIRS]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *sums)


def _whole(rows: DataFrame) -> DataFrame:
    """Start 2: mean and covariance of all documents."""
    return _sums(rows, ["key"]).withColumn("start", F.lit(2)).mapInPandas(_solve, _GROUP)


def _binned(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """Rows with the bin of their distance under each start of their group."""
    near = _meet(rows, groups.select("key", "start", "centre", "inverse"), n_groups, "key")
    d2 = _distance(F.col("centre"), F.col("inverse"))
    return near.select("key", "start", *[f"q{i}" for i in range(P)], _bin(d2).alias("bin"))


def _concentrate(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """One step: estimates from each group's nearest documents, per start."""
    bins = _sums(_binned(rows, groups, n_groups), ["key", "start", "bin"])
    own = Window.partitionBy("key", "start")
    before = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    seen, every = F.coalesce(F.sum("n").over(before), F.lit(0)), F.sum("n").over(own)
    near = bins.withColumn("in", seen < every * KEPT_SHARE).filter("in")
    moments = near.groupBy("key", "start").agg(
        *[F.sum(c).alias(c) for c in bins.columns if c == "n" or c[0] == "s" and c != "start"]
    )
    return _few(moments, n_groups).mapInPandas(_solve, _GROUP)


def _scales(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """(key, scale, n_docs): what makes a group's median distance that of chi-squared, never
    under 1, so a unit never shrinks below the floor."""
    bins = _binned(rows, groups, n_groups).groupBy("key", "bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("key")
    before = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("low", F.coalesce(F.sum("n").over(before), F.lit(0)) * 2 < F.sum("n").over(own))
    median = F.pow(F.lit(2.0), F.max(F.when(F.col("low"), F.col("bin"))) / BINS) - 1.0
    return bins.groupBy("key").agg(F.greatest(F.lit(1.0), median / MEDIAN).alias("scale"), F.sum("n").alias("n_docs"))


def estimates(vectors: DataFrame) -> DataFrame:
    """(key, centre, cov, inverse, logdet, scale, n_docs) of every group of all three levels."""
    rows = vectors.select(F.explode(F.array("k2", "k1", "k0")).alias("key"), *[f"q{i}" for i in range(P)])
    found = landed(_medians(rows).unionAll(_whole(rows)), "mcd")
    n_groups = found.count()
    # The starts rest on no subset, so their determinants don't count.
    found = landed(_concentrate(rows, found, n_groups).withColumn("moving", F.lit(True)), "mcd")
    moving = n_groups
    while moving:
        step = _concentrate(rows, found.filter("moving"), moving).select("key", "start", F.struct(*_ESTIMATES).alias("new"))
        both = found.join(step, ["key", "start"], "left")
        better = F.coalesce(F.col("new.logdet") < F.col("logdet") - 1e-9, F.lit(False))
        found = both.select(
            "key", "start", *[F.when(better, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in _ESTIMATES],
            better.alias("moving"),
        )
        found = landed(_few(found, n_groups), "mcd")
        moving = found.filter("moving").count()
    least = found.groupBy("key").agg(F.min(F.struct("logdet", "start", "centre", "cov", "inverse")).alias("e"))
    best = least.select("key", *[F.col(f"e.{c}").alias(c) for c in ("start", *_ESTIMATES)])
    best = landed(_few(best, n_groups), "mcd")
    return _few(best.join(_scales(rows, best, n_groups), "key"), n_groups)


_ESTIMATES = ("centre", "cov", "inverse", "logdet")


def _towards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Estimates of the finest groups, each level moved towards the one above."""
    for f in frames:
        out = []
        for r in f.itertuples(index=False):
            centre, cov, scale = np.array(r.c0), np.array(r.v0).reshape(P, P), r.s0
            for c, v, s, n in ((r.c1, r.v1, r.s1, r.n1), (r.c2, r.v2, r.s2, r.n2)):
                w = n / (n + SHARED)
                apart = np.array(c) - centre
                # Two groups' mixture: their covariances, and what lies between their centres.
                cov = w * np.array(v).reshape(P, P) + (1 - w) * cov + w * (1 - w) * np.outer(apart, apart)
                centre, scale = centre + w * apart, w * s + (1 - w) * scale
            out.append((r.k2, centre.tolist(), np.linalg.inv(cov).ravel().tolist(), float(scale)))
        yield pd.DataFrame(out, columns=["k2", "centre", "inverse", "scale"])


def group_estimates(vectors: DataFrame) -> DataFrame:
    """(k2, centre, inverse, scale) of every language and source."""
    every = landed(estimates(vectors), "mcd")
    groups = vectors.select("k2", "k1", "k0").distinct()
    for level in (0, 1, 2):
        one = every.select(
            F.col("key").alias(f"k{level}"), F.col("centre").alias(f"c{level}"), F.col("cov").alias(f"v{level}"),
            F.col("scale").alias(f"s{level}"), F.col("n_docs").cast("double").alias(f"n{level}"),
        )
        groups = groups.join(one, f"k{level}")
    wanted = ["k2"] + [f"{c}{level}" for level in (0, 1, 2) for c in "cvsn"]
    return groups.select(*wanted).mapInPandas(_towards, "k2 string, centre array<double>, inverse array<double>, scale double")


def judge(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept) per row of ``docs``.

    base_failed: under 10 words, or over 20 % of the words in repeated 5-word windows. A
    document that passes is kept if its squared distance is at most CUT. Null text has no
    words and fails. Null language or source is a group of its own. Repeated rows are judged
    alike. An empty table gives no row; other columns are not read.
    """
    counted = statistics(docs, key)
    vectors = landed(counted.select("doc_id", *COUNTS[:5], *_keys(), *_vector()), "vectors")
    groups = landed(group_estimates(vectors), "mcd")
    out = _meet(vectors, groups, groups.count(), "k2", "left")
    distance = _distance(F.col("centre"), F.col("inverse")) / F.col("scale")
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 10) | (repeated * 100 > n * 20)
    out = out.withColumn("distance", distance).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT)
    return out.select("doc_id", *COUNTS[:5], "base_failed", "distance", kept.alias("kept"))
