"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every whole text becomes a vector of P transformed statistics (logarithms of smoothed shares,
so a short text lies near ordinary ones), in whole numbers of 1/UNIT. Fitting is one pass:
each task sums counts, vectors and products of its labelled documents per class, Spark adds
the sums up. They are whole numbers, so the model doesn't depend on the order of tasks, and
its size is fixed. A class's covariance is shrunk twice: towards the pooled one as if
``SHARED`` more documents had it, so the estimate passes smoothly from a class of two
documents to one of millions, then by the variances ``FLOOR`` on the diagonal. Its Cholesky
factor is computed once per model and travels with the scoring function. The score is the
logistic of the difference of both classes' log densities, each minus half the squared
Mahalanobis distance and minus the logarithm of the factor's diagonal, plus that of priors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Words, landed, slices, text_of, window_hashes

#: Statistics of a document, and the standard deviation each class has at least.
FLOOR = {
    "length": 0.5,
    "word length": 0.05,
    "spread of word length": 0.1,
    "letters": 0.02,
    "capitals": 0.25,
    "sentence ends": 0.2,
    "exclamation marks": 0.25,
    "symbols": 0.25,
    "digits": 0.25,
    "other marks": 0.25,
    "distinct words": 0.05,
    "commonest word": 0.2,
    "word after itself": 0.25,
    "repeated windows": 0.25,
    "repeated lines": 0.25,
}
P = len(FLOOR)
UNIT = 1 << 10
#: Documents' worth of the pooled covariance in each class, and the window of repeats.
SHARED, WINDOW = 50, 5

_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
N_SUMS = 1 + P + len(_PAIRS)


def _bytes(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


_ENDS, _BANG, _DIGIT = _bytes(b".!?"), _bytes(b"!"), _bytes(b"0123456789")
_SYMBOL, _OTHER = _bytes(b"#*$%&|<>@\\^_`{}~+=[]/"), _bytes(b"\"'(),-:;")


def _most_and_distinct(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of n groups, how often its commonest value occurs, and its distinct values."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(g)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, g[at], times)
    return most, np.bincount(g[at], minlength=n)


def vectors(texts: list[str]) -> np.ndarray:
    """One row of P whole numbers per text."""
    k, w = len(texts), Words(texts)
    n = np.diff(w.at)
    own = np.repeat(np.arange(k), n)
    edge = np.minimum(w.begin, len(w.raw))
    over = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[edge])
    raw = w.raw
    upper = (raw >= 65) & (raw <= 90)
    letters = over(upper | ((raw >= 97) & (raw <= 122)) | (raw >= 0xC0))
    visible = over(((raw & 0xC0) != 0x80) & ~((raw == 32) | ((raw >= 9) & (raw <= 13))))
    # Code points per word: bytes that don't continue a character.
    run = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    size = run[w.ends] - run[w.starts]
    squares = np.bincount(own, weights=size.astype(float) ** 2, minlength=k)
    most, distinct = _most_and_distinct(own, w.hashes, k)
    again = np.bincount(own[1:][(w.hashes[1:] == w.hashes[:-1]) & (own[1:] == own[:-1])], minlength=k)
    windows = window_hashes(w.hashes, WINDOW)
    inside = own[: len(windows)] == own[WINDOW - 1 :][: len(windows)]
    starts = own[: len(windows)][inside]
    _, different = _most_and_distinct(starts, windows[inside], k)
    repeated = np.bincount(starts, minlength=k) - different
    lines, same = np.zeros(k), np.zeros(k)
    for i, text in enumerate(texts):
        full = [x for x in text.split("\n") if x.strip()]
        lines[i], same[i] = len(full), len(full) - len(set(full))
    mean = (size_sum := visible + 100.0) / (n + 20)
    x = [
        np.log(n + 20.0),
        np.log(mean),
        np.log(np.maximum(1.0, (squares + 660) / (n + 20) - mean**2)) / 2,
        np.log((letters + 100) / size_sum),
        np.log((over(upper) + 4) / (letters + 100)),
        np.log((over(_ENDS[raw]) + 3) / (n + 20)),
        np.log((over(_BANG[raw]) + 0.5) / (n + 20)),
        np.log((over(_SYMBOL[raw]) + 0.5) / (n + 20)),
        np.log((over(_DIGIT[raw]) + 0.5) / (n + 20)),
        np.log((over(_OTHER[raw]) + 2) / (n + 20)),
        np.log(distinct + 20) / np.log(n + 20),
        np.log((most + 2) / (n + 20)),
        np.log((again + 0.5) / (n + 20)),
        np.log((repeated + 1) / (n + 20)),
        np.log((same + 0.5) / (lines + 5)),
    ]
    return np.round(np.stack(x, axis=1) * UNIT).astype(np.int64)


def statistics(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, x) per row; null text is empty. Language, source and other columns aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                x = vectors(texts[a:b])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, P, dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), flat], ["doc_id", "x"])

    own = docs.select(F.col(key).cast("long").alias("doc_id"), text_of("text").alias("text"))
    return own.mapInArrow(run, "doc_id long, x array<long>")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: class, and its count, sums and sums of products in one row."""
    total = np.zeros((2, N_SUMS), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column("x").flatten().to_numpy().reshape(-1, P)
        label = batch.column("label").to_numpy()
        for c in (0, 1):
            mine = x[label == c]
            product = mine.T @ mine
            total[c] += np.concatenate([[len(mine)], mine.sum(axis=0), [product[i, j] for i, j in _PAIRS]])
    for c in (0, 1):
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([total[c].tolist()])], ["label", "s"])


def labels_of(labels: DataFrame, column: str = "quality", key: str = "doc_id") -> DataFrame:
    """(doc_id, label) once per document: what most of its rows say; a tie says nothing, nor
    does a label other than 0 and 1 or a row without doc_id."""
    value = F.col(column).cast("int")
    votes = (
        labels.filter(value.isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).cast("long").alias("doc_id"))
        .agg(F.sum(2 * value - 1).alias("vote"))
    )
    return votes.filter("vote <> 0").select("doc_id", (F.col("vote") > 0).cast("int").alias("label"))


@dataclass(frozen=True)
class Model:
    """Sums of each class: documents, sum of vectors, sums of products (whole numbers)."""

    sums: tuple[tuple[int, ...], tuple[int, ...]]

    @cached_property
    def factors(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Per class: mean, lower Cholesky factor of the shrunk covariance, log density at
        the mean and prior together (up to what both classes share)."""
        n = [s[0] for s in self.sums]
        mean, scatter = [], []
        for s in self.sums:
            own = np.array([v / max(s[0], 1) for v in s[1 : 1 + P]])
            square = np.zeros((P, P))
            for (i, j), v in zip(_PAIRS, s[1 + P :], strict=True):
                # Whole numbers, so nothing is lost where a mean is large and a spread small.
                square[i, j] = square[j, i] = (v * max(s[0], 1) - s[1 + i] * s[1 + j]) / max(s[0], 1)
            mean.append(own / UNIT)
            scatter.append(square / UNIT**2)
        pooled = (scatter[0] + scatter[1]) / max(sum(n), 1)
        floor = np.diag(np.array(list(FLOOR.values())) ** 2)
        out = []
        for c in (0, 1):
            shrunk = (scatter[c] + SHARED * pooled) / (n[c] + SHARED) + floor
            factor = np.linalg.cholesky(shrunk)
            prior = np.log((n[c] + 1) / (sum(n) + 2))
            out.append((mean[c], factor, float(prior - np.log(np.diag(factor)).sum())))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row of whole numbers; the class that was seen if
        there is one only, 0.5 without any labelled document."""
        seen = [s[0] > 0 for s in self.sums]
        if not all(seen):
            return np.full(len(x), 0.5 if not any(seen) else float(seen[1]))
        log = []
        for mean, factor, at_mean in self.factors:
            # Forward substitution column by column, so a row's score doesn't depend on its batch.
            d2, z = np.zeros(len(x)), []
            for i in range(P):
                rest = x[:, i] / UNIT - mean[i]
                for j in range(i):
                    rest = rest - factor[i, j] * z[j]
                z.append(rest / factor[i, i])
                d2 += z[i] ** 2
            log.append(at_mean - d2 / 2)
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(labelled: DataFrame) -> Model:
    """The model of (x, label) rows. Two rows of N_SUMS numbers come to the driver."""
    per_task = labelled.select("x", "label").mapInArrow(_sums, "label int, s array<long>")
    added = (
        per_task.select("label", F.posexplode("s").alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        .collect()
    )
    sums = [[0] * N_SUMS, [0] * N_SUMS]
    for r in added:
        sums[r["label"]][r["i"]] = int(r["v"])
    return Model((tuple(sums[0]), tuple(sums[1])))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """Rows of ``statistics`` with score and predicted."""
    _ = model.factors  # computed here, once; tasks get it with the function

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = model.score(batch.column("x").flatten().to_numpy().reshape(-1, P))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")


def is_held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Learns from all rows with a label whose doc_id isn't held out; rows that repeat a doc_id
    each count. Null text is empty; an empty text is scored like any other. A null doc_id has
    no label and isn't held out. Without documents there is no row; without labels every
    score is 0.5, and with one class only its label. Other columns of either table, whatever
    their names, aren't read.
    """
    stats = landed(statistics(docs), "statistics")
    known = labels_of(labels, column)
    learned = stats.filter(~is_held_out()).join(known, "doc_id")
    model = fit(learned)
    return scored(stats, model).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
