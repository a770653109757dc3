"""Vector codes: product quantisation whose assignments keep Drake-Hamerly bounds.

A vector of whole numbers is cut into PARTS equal parts, each with a codebook of up to
ENTRIES entries. Per part a row keeps its b closest entries in order, a lower bound of its
distance to each and one outer bound for all others. When entries move, bounds shrink by how
far each moved (the outer one by the farthest). The current entry's distance is computed
exactly; where it is below every bound from rank z on, only ranks before z are compared, by
exact whole-number distances, and where even the outer bound is reached, all entries. So the
bounds decide only what need not be computed, and codes equal those of a full comparison,
ties to the lower index included.

Bounds are rounded down to whole numbers and held in 16 bits (a larger one counts as 65,535,
which is still a lower bound). b starts at a quarter of the entries and shrinks after every
round to what the rows needed, an eighth at least (``next_width``). Rows with their bounds are landed after every round: a lost executor costs
a reread. Only entries (ENTRIES x length of a vector), their sums per task and the counts of
needed ranks ever leave the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import free_name, landed

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Closest entries kept at first, and at least; share of the rows whose need b covers.
WIDTH, LEAST_WIDTH, COVER = ENTRIES // 4, ENTRIES // 8, 0.99
#: Bound that stands for itself or anything larger; entry that stands for none.
FAR, NONE = 0xFFFF, 0xFF


def whole_vectors(
    vectors: DataFrame, vector: str, key: str, label: str, scale: int = SCALE
) -> DataFrame:
    """(vec_id, label, x): components as floor(scale * x), rows that can't be coded left out.

    Rows go whose vector is null, empty, of a length that PARTS doesn't divide, or holds null
    or non-finite components. Components so large that a squared distance would pass 64 bits
    raise an error.
    """
    inf = float("inf")
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0)
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < inf))
    most = F.sqrt(F.lit(2.0**61) / F.size(vector)) / scale
    fits = F.forall(vector, lambda v: F.abs(v.cast("double")) < most)
    whole = F.transform(vector, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    refused = F.raise_error(F.lit("a component is too large for 64-bit squared distances"))
    return vectors.filter(usable & F.coalesce(finite, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.when(fits, whole).otherwise(refused.cast("array<int>")).alias("x"),
    )


@dataclass(frozen=True)
class Codebooks:
    """Entries per part, entry and position; how far each moved in the last round (rounded
    up), all 0 before the first."""

    entries: np.ndarray
    moved: np.ndarray = field(default=None)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def first_entries(rows: DataFrame) -> Codebooks | None:
    """The parts of the ENTRIES smallest ids, ascending; null counts as the largest id. An id
    that several rows have gives its smallest vector. Vectors have the length of the first.
    At most ENTRIES rows come to the driver."""
    shortest = rows.select("vec_id", F.size("x").alias("n")).orderBy(F.col("vec_id").asc_nulls_last(), "n").first()
    if shortest is None:
        return None
    alike = rows.filter(F.size("x") == shortest["n"])
    ids = alike.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES).collect()
    named = [r["vec_id"] for r in ids if r["vec_id"] is not None]
    wanted = F.col("vec_id").isin(named)
    if len(named) < len(ids):
        wanted = F.col("vec_id").isNull() | wanted
    first = alike.filter(wanted).groupBy("vec_id").agg(F.min("x").alias("x")).collect()
    first.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    flat = np.array([r["x"] for r in first], np.int64)
    entries = flat.reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    return Codebooks(entries, np.zeros(entries.shape[:2], np.int64))


# ---- inside tasks ----


def _root(square: np.ndarray) -> np.ndarray:
    """Whole part of the square root, exactly."""
    r = np.sqrt(square.astype(np.float64)).astype(np.int64)
    r -= r * r > square
    return r + ((r + 1) * (r + 1) <= square)


def _bound(square: np.ndarray) -> np.ndarray:
    return np.minimum(_root(square), FAR)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all entries of a part."""
    largest = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4.0 * x.shape[1] * float(largest) ** 2 < 2**53 else np.int64
    a, c = x.astype(kind), entries.astype(kind)
    return ((a**2).sum(1)[:, None] - 2 * (a @ c.T) + (c**2).sum(1)[None, :]).astype(np.int64)


def _closest(x: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By a full comparison: the closest entries in order, their bounds, the outer bound and
    the squared distance to the first."""
    d2 = _squares(x, entries)
    order = np.argsort(d2, axis=1, kind="stable")  # ties: lower index first
    ranked = np.take_along_axis(d2, order, axis=1)
    n, k = d2.shape
    near, low = np.full((n, width), NONE, np.int64), np.full((n, width), FAR, np.int64)
    b = min(width, k)
    near[:, :b], low[:, :b] = order[:, :b], _bound(ranked[:, :b])
    outer = _bound(ranked[:, b]) if k > b else np.full(n, FAR, np.int64)
    return near, low, outer, ranked[:, 0]


def _keep(near: np.ndarray, low: np.ndarray, outer: np.ndarray, width: int):
    """To the given width: what is cut off joins those under the outer bound."""
    if near.shape[1] > width:
        outer = np.minimum(outer, low[:, width:].min(axis=1))
        return near[:, :width], low[:, :width], outer
    more = width - near.shape[1]
    pad = lambda a, v: np.pad(a, ((0, 0), (0, more)), constant_values=v)
    return pad(near, NONE), pad(low, FAR), outer


def assign_part(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray, width: int
):
    """One part of all rows, from the bounds under the entries before they moved.

    Returns the bounds under the entries as they are (``width`` closest), each row's exact
    squared distance, and the ranks it needed: 1 for the current entry alone, 0 for all."""
    n, b = near.shape
    drift = np.append(moved, np.zeros(NONE + 1 - len(moved), np.int64))
    low = np.maximum(low - drift[near], 0)
    outer = np.maximum(outer - moved.max(initial=0), 0)
    at = entries[near[:, 0]]
    d2 = ((x - at) ** 2).sum(axis=1)
    # rest[:, j]: bound of every entry that doesn't stand before rank j.
    rest = np.minimum.accumulate(np.column_stack([low, outer])[:, ::-1], axis=1)[:, ::-1]
    clear = rest[:, 1:].astype(np.int64) ** 2 > d2[:, None]
    need = np.where(clear.any(axis=1), clear.argmax(axis=1) + 1, 0)
    low[:, 1:] = rest[:, 1:b]
    low[:, 0] = _bound(d2)
    for z in range(2, b + 1):
        mine = np.flatnonzero(need == z)
        if not len(mine):
            continue
        some = near[mine, :z]
        real = np.where(some == NONE, 0, some)
        exact = ((x[mine, None, :] - entries[real]) ** 2).sum(axis=2)
        exact[some == NONE] = np.iinfo(np.int64).max
        order = np.lexsort((some, exact), axis=1)
        exact = np.take_along_axis(exact, order, axis=1)
        near[mine, :z] = np.take_along_axis(some, order, axis=1)
        low[mine, :z] = np.where(exact == np.iinfo(np.int64).max, FAR, _bound(np.minimum(exact, 1 << 62)))
        d2[mine] = exact[:, 0]
    near, low, outer = _keep(near, low, outer, width)
    full = np.flatnonzero(need == 0)
    if len(full):
        near[full], low[full], outer[full], d2[full] = _closest(x[full], entries, width)
    return near, low, outer, d2, need


def _rows(batch: pa.RecordBatch, length: int) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, length)
    return x.astype(np.int64).reshape(batch.num_rows, PARTS, -1)


def _blobs(a: np.ndarray, kind) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(a.astype(kind))], pa.binary())


def _unblob(column: pa.Array, kind, n: int) -> np.ndarray:
    joined = np.frombuffer(b"".join(column.to_pylist()), kind)
    return joined.reshape(n, PARTS, -1).astype(np.int64)


def _assigned(batch: pa.RecordBatch, books: Codebooks, width: int, first: bool):
    n, (_, _, size) = batch.num_rows, books.entries.shape
    x = _rows(batch, PARTS * size)
    if not first:
        old = [_unblob(batch.column(c), k, n) for c, k in (("near", np.uint8), ("low", np.uint16), ("outer", np.uint16))]
    parts = []
    for p in range(PARTS):
        own = np.ascontiguousarray(x[:, p])
        if first:
            parts.append((*_closest(own, books.entries[p], width), np.zeros(n, np.int64)))
        else:
            near, low, outer = old[0][:, p].copy(), old[1][:, p], old[2][:, p, 0]
            parts.append(assign_part(own, books.entries[p], books.moved[p], near, low, outer, width))
    return [np.stack(a, axis=1) for a in zip(*parts, strict=True)]


def assign(rows: DataFrame, books: Codebooks, width: int, *, first: bool, last: bool) -> DataFrame:
    """Codes of all rows under the entries: with their bounds, or (``last``) with the exact
    squared distance summed over parts. ``label`` stays beside them."""
    kind = next(f.dataType for f in rows.schema.fields if f.name == "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near, low, outer, d2, need = _assigned(batch, books, width, first)
            named = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": _blobs(near[:, :, 0], np.uint8)}
            if last:
                named["error"] = pa.array(d2.sum(axis=1))
            else:
                named |= {
                    "x": batch.column("x"), "near": _blobs(near, np.uint8), "low": _blobs(low, np.uint16),
                    "outer": _blobs(outer, np.uint16), "need": _blobs(need, np.uint8),
                }
            yield pa.RecordBatch.from_arrays(list(named.values()), list(named))

    out = f"vec_id long, label {kind.simpleString()}, code binary, "
    out += "error long" if last else "x array<int>, near binary, low binary, outer binary, need binary"
    read = ("vec_id", "label", "x") if first else ("vec_id", "label", "x", "near", "low", "outer")
    return rows.select(*read).mapInArrow(run, out)


def _gather(size: int, n_entries: int):
    """Per task: sums and count per part and entry, and counts of needed ranks (part -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, n_entries, size + 1), np.int64)
        ranks = np.zeros(NONE + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, PARTS * size)
            code = _unblob(batch.column("code"), np.uint8, batch.num_rows)[:, :, 0]
            for p in range(PARTS):
                np.add.at(total[p], code[:, p], np.column_stack([x[:, p], np.ones(len(x), np.int64)]))
            ranks += np.bincount(_unblob(batch.column("need"), np.uint8, batch.num_rows).ravel(), minlength=NONE + 1)
        part, entry = np.nonzero(total[:, :, size])
        sums = [*total[part, entry].tolist(), *[[int(v)] for v in ranks[ranks > 0]]]
        part = [*part.tolist(), *[-1] * int((ranks > 0).sum())]
        entry = [*entry.tolist(), *np.flatnonzero(ranks).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(sums, pa.list_(pa.int64()))],
            ["part", "entry", "sums"],
        )

    return run


def moved_entries(rows: DataFrame, books: Codebooks) -> tuple[Codebooks, dict[int, int]]:
    """Entries replaced by the componentwise floor of their rows' mean, unused ones kept, and
    how many parts of rows needed which rank. One row per entry and rank comes to the driver."""
    _, n_entries, size = books.entries.shape
    per_task = rows.select("x", "code", "need").mapInArrow(
        _gather(size, n_entries), "part int, entry int, sums array<long>"
    )
    total = (
        per_task.select("part", "entry", F.posexplode("sums").alias("i", "v"))
        .groupBy("part", "entry", "i")
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        .groupBy("part", "entry")
        .agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("sums"))
        .collect()
    )
    entries, ranks = books.entries.copy(), {}
    for r in total:
        sums = [int(s["v"]) for s in r["sums"]]
        if r["part"] < 0:
            ranks[r["entry"]] = sums[0]
        else:
            entries[r["part"], r["entry"]] = [s // sums[-1] for s in sums[:-1]]
    square = ((entries - books.entries) ** 2).sum(axis=2)
    whole = _root(square)
    return Codebooks(entries, whole + (whole * whole < square)), ranks


def next_width(ranks: dict[int, int], width: int) -> int:
    """b for the next round: as many as COVER of the rows compared by rank needed."""
    compared = sum(n for z, n in ranks.items() if z)
    seen = 0
    for z in sorted(z for z in ranks if z):
        seen += ranks[z]
        if seen >= COVER * compared:
            return max(LEAST_WIDTH, min(width, z))
    return width  # all were compared in full, as in the first round: nothing is known


def quantise(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code, error) per vector that can be coded, and the codebooks.

    ``code`` holds PARTS bytes. Rows without a usable vector go (see ``whole_vectors``), and
    those of another length than the vector with the smallest id; all others are coded, those
    with null or repeated ids included. Without rows there are no codebooks. Under ENTRIES
    ids there are as many entries as ids. Other columns aren't read.
    """
    rows = landed(whole_vectors(vectors, vector, key, label), "vectors")
    books = first_entries(rows)
    if books is None:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.limit(0), None
    rows = rows.filter(F.size("x") == books.entries.shape[0] * books.entries.shape[2])
    width, first = WIDTH, True
    for _ in range(rounds):
        rows = landed(assign(rows, books, width, first=first, last=False), "assigned")
        books, ranks = moved_entries(rows, books)
        width, first = next_width(ranks, width), False
    return assign(rows, books, width, first=first, last=True), books


def label_errors(coded: DataFrame) -> DataFrame:
    """Rows with ``label_error``, the errors of equal labels (nulls together) added up. Sums
    are landed by label first, so the rows of a hot label meet a single row, whichever join
    the planner takes."""
    name = free_name(coded, "of_label")
    sums = coded.groupBy(F.col("label").alias(name)).agg(F.sum("error").alias("label_error"))
    sums = landed(sums, "label_errors")
    return coded.join(sums, coded["label"].eqNullSafe(sums[name])).drop(name)


def codes(vectors: DataFrame, names: Sequence[str] = ("embedding", "vec_id", "label")) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): code in hex, two digits a part."""
    coded, books = quantise(vectors, *names)
    out = label_errors(landed(coded, "codes"))
    return out.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.sha256 if books else "").alias("codebooks_sha256"),
    )
