"""Phrase collocations by set-oriented mining: occurrence relations, joined and counted level
by level.

The relation of level k holds (chunk, at, group): at this place of this chunk a phrase of k
words begins. ``at`` numbers words with a gap between pieces, so two places are neighbours
in one piece exactly if they differ by one. Each level is landed sorted by place and extended
by a merge join of the relation with itself at the adjacent place: a frequent phrase at p and
one at p + 1 overlap in all but their ends and make the phrase of k + 1 words at p. Groups
are counted in each chunk, then over all chunks, and those under the threshold are taken out
before the next level is built: one shuffle of a chunk's groups serves the count and the
semi-join. A phrase's parts occur at least as often as itself, so nothing is lost.

Nearly all neighbours are rare pairs, one or two to a chunk, so pairs don't travel as rows: a
chunk sends one packed block for each range of pairs (by a hash that only deals them out), its
ends sorted, as differences. A range holds the pairs of about RANGE words of the table.

A chunk is up to CHUNK words of one language, and 4 words on where it ends inside a piece:
phrases are counted where they begin. So a hot language is many chunks, a hot phrase sends
one entry for each chunk, however often it occurs there, and a list of a chunk's groups is
bounded. Words are compared as text, phrases by the numbers of their frequent parts: nothing
is hashed, and counts are exact. A group's number is the first place among its chunks' lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import landed, lower_ascii, mix, slices, text_of

#: Words of a chunk, of all chunks a task holds at a time, and bytes split at a time.
CHUNK, HELD, PIECE = 1 << 21, 1 << 22, 4 << 20
LONGEST, LEAST, SHARE, TOP = 5, 100, 100, 2000
#: Rows of groups in one Arrow batch.
ROWS = 1 << 16
#: Words of the table for each range of pairs.
RANGE = 1 << 20
#: Bits of a group's index in its chunk, and of a chunk's number in its task.
INDEX, NUMBER = 22, 17

#: 0 inside a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**63 - 1, byte by byte of equal weight, compressed; as many
    bytes a number as the largest needs."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(numbers).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:5], "little")
    planes = np.frombuffer(pa.decompress(blob[5:], width * n, "zstd", asbytes=True), np.uint8)
    numbers = np.zeros((n, 8), np.uint8)
    numbers[:, :width] = planes.reshape(width, n).T
    return numbers.view("<i8").ravel()


def _pack_sorted(numbers: np.ndarray) -> bytes:
    return _pack(np.diff(numbers, prepend=0))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob))


class _Words:
    """Words of one language as they come: their text and, for each, whether a piece ends
    before it."""

    def __init__(self):
        self.text: list[pa.Array] = []
        self.first: list[np.ndarray] = []
        self.n = 0

    def add(self, data: np.ndarray) -> None:
        """More text; a new piece begins with it. Cut into PIECE bytes at white space or marks,
        so that memory is bounded by the longest word."""
        begin, fresh = 0, True
        while begin < len(data):
            end = begin + PIECE
            while end < len(data):
                cut = np.flatnonzero(_KIND[data[end : end + PIECE]])
                end = end + (int(cut[0]) if len(cut) else PIECE)
                if len(cut):
                    break
            fresh = self._part(data[begin:end], fresh)
            begin = end

    def _part(self, data: np.ndarray, fresh: bool) -> bool:
        kind = _KIND[data]
        outside = np.ones(len(data) + 2, bool)
        outside[1:-1] = kind > 0
        edges = np.flatnonzero(outside[1:] != outside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        marks = np.flatnonzero(kind == 2)
        if not len(starts):
            return fresh or len(marks) > 0
        before = np.searchsorted(marks, starts)
        first = np.diff(before, prepend=0) > 0
        first[0] |= fresh
        letters = lower_ascii(data[kind == 0])
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        self.text.append(
            pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters.tobytes()))
        )
        self.first.append(first)
        self.n += len(starts)
        return len(marks) > before[-1]

    def chunks(self) -> Iterator[tuple[np.ndarray, int, np.ndarray, pa.Array, np.ndarray]]:
        """(at, places that count, group, words, times) of up to CHUNK words each."""
        if not self.n:
            return
        text, first = pa.chunked_array(self.text), np.concatenate(self.first)
        for a in range(0, self.n, CHUNK):
            b = min(a + CHUNK, self.n)
            ahead = first[b : b + LONGEST - 1]
            end = b + (int(ahead.argmax()) if ahead.any() else len(ahead))
            coded = pa.concat_arrays(text.slice(a, end - a).chunks).dictionary_encode()
            group = coded.indices.to_numpy().astype(np.int64)
            at = np.arange(end - a) + np.cumsum(first[a:end])
            counted = int(at[b - a - 1]) + 1
            times = np.bincount(group[: b - a], minlength=len(coded.dictionary))
            yield at, counted, group, coded.dictionary, times


def _number() -> int:
    """Upper bits of the chunk numbers of this task."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << NUMBER


_RELATION = "chunk long, lang string, counted long, at binary, groups binary"
#: What rows of words and of blocks of pairs have besides.
_WORD = {"place": pa.int64(), "times": pa.int64(), "word": pa.string()}
_BLOCK = {"range": pa.int64(), "first": pa.int64(), "l": pa.binary(), "r": pa.binary(), "times": pa.binary()}


def _chunk_row(chunk: int, lang: str, counted: int, at: np.ndarray, group: np.ndarray, extra: dict) -> pa.RecordBatch:
    named = {
        "chunk": pa.array([chunk], pa.int64()), "lang": pa.array([lang], pa.string()),
        "counted": pa.array([counted], pa.int64()), "at": pa.array([_pack_sorted(at)], pa.binary()),
        "groups": pa.array([_pack(group)], pa.binary()),
    } | {c: pa.nulls(1, kind) for c, kind in extra.items()}
    return pa.RecordBatch.from_arrays(list(named.values()), list(named))


def _limited(n: int) -> None:
    if n >> INDEX:
        raise ValueError(f"more than {1 << INDEX} groups in a chunk")


def _word_rows(chunk: int, lang: str, times: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    _limited(len(times))
    for a in range(0, len(times), ROWS):
        n = min(ROWS, len(times) - a)
        named = {
            "chunk": pa.nulls(n, pa.int64()), "lang": pa.array([lang] * n, pa.string()),
            "counted": pa.nulls(n, pa.int64()), "at": pa.nulls(n, pa.binary()), "groups": pa.nulls(n, pa.binary()),
            "place": pa.array((chunk << INDEX) + np.arange(a, a + n)), "times": pa.array(times[a : a + n].astype(np.int64)),
            "word": words.slice(a, n),
        }
        yield pa.RecordBatch.from_arrays(list(named.values()), list(named))


def _blocks(chunk: int, lang: str, ranges: np.ndarray, left: np.ndarray, right: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """A row per range: the pairs of a chunk, which are sorted by range, left and right end.
    ``first`` is the index of a block's first pair."""
    cut = np.flatnonzero(np.diff(ranges, prepend=-1))
    ends = [*cut[1:], len(ranges)]
    packed = lambda f, x: pa.array([f(x[a:b]) for a, b in zip(cut, ends, strict=True)], pa.binary())
    n = len(cut)
    named = {
        "chunk": pa.array([chunk] * n, pa.int64()), "lang": pa.array([lang] * n, pa.string()),
        "counted": pa.nulls(n, pa.int64()), "at": pa.nulls(n, pa.binary()), "groups": pa.nulls(n, pa.binary()),
        "range": pa.array(ranges[cut]), "first": pa.array(cut.astype(np.int64)),
        "l": packed(_pack_sorted, left), "r": packed(_pack, right), "times": packed(_pack, times),
    }
    return pa.RecordBatch.from_arrays(list(named.values()), list(named))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Words] = {}
    number = _number()

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal number
        for at, counted, group, words, times in held.pop(lang).chunks():
            yield _chunk_row(number, lang, counted, at, group, _WORD)
            yield from _word_rows(number, lang, times, words.cast(pa.string()))
            number += 1

    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for a, b in slices(texts):
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(texts[a:b], langs[a:b], strict=True):
                by_lang.setdefault(lang, []).append(text.encode())
            for lang, own in by_lang.items():  # a line break ends a piece
                held.setdefault(lang, _Words()).add(np.frombuffer(b"\n".join(own), np.uint8))
                while sum(w.n for w in held.values()) > HELD:
                    yield from flush(max(held, key=lambda x: held[x].n))
    for lang in list(held):
        yield from flush(lang)


def first_level(docs: DataFrame) -> DataFrame:
    """The relation of single words: a row per chunk, and one per distinct word of a chunk.
    Null text is empty, null language ``und``; a text begins a new piece."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of("text").alias("text"))
    return own.mapInArrow(_split, f"{_RELATION}, place long, times long, word string")


def _numbers(column: pa.Array) -> np.ndarray:
    """Numbers that stand in rows, or packed in several."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.concatenate([_unpack(x) for x in column.to_pylist()])
    return column.to_numpy(zero_copy_only=False)


def _extend(last: bool, n_ranges: int):
    """The next level's relation and pairs of chunks whose frequent groups are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                chunk, lang, counted = cell("chunk"), cell("lang"), cell("counted")
                found = batch.column("found")[i].values
                idx, gid = (_numbers(found.field(k)) for k in (0, 1))
                order = np.argsort(gid)
                idx, gid = idx[order], gid[order]
                at, group = _unpack_sorted(cell("at")), _unpack(cell("groups"))
                known = np.full(int(max(group.max(initial=0), idx.max(initial=0))) + 1, -1)
                known[idx] = np.arange(len(idx))
                group = known[group]
                at, group = at[group >= 0], group[group >= 0]
                beside = at[1:] == at[:-1] + 1
                at = at[:-1][beside]
                pair = group[:-1][beside] * len(idx) + group[1:][beside]
                pairs, own = np.unique(pair, return_inverse=True)
                if not len(pairs):
                    continue
                _limited(len(pairs))
                left, right = gid[pairs // len(idx)], gid[pairs % len(idx)]
                with np.errstate(over="ignore"):
                    h = mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))
                ranges = (h % np.uint64(n_ranges)).astype(np.int64)
                order = np.argsort(ranges, kind="stable")
                index = np.empty(len(order), np.int64)
                index[order] = np.arange(len(order))
                own = index[own]
                times = np.bincount(own[at < counted], minlength=len(pairs))
                if not last:
                    yield _chunk_row(chunk, lang, counted, at, own, _BLOCK)
                yield _blocks(chunk, lang, ranges[order], left[order], right[order], times)

    return run


def frequent_words(relation: DataFrame, least: int) -> DataFrame:
    """(place, gid, f, lang, word) of the words of every chunk that occur ``least`` times over
    all chunks. ``gid`` is the same in all chunks; ``f``, lang and word stand where place and
    gid agree."""
    same = Window.partitionBy("lang", "word")
    counted = relation.filter("place is not null").select("place", "times", "lang", "word")
    counted = counted.withColumns({"f": F.sum("times").over(same), "gid": F.min("place").over(same)})
    first = F.col("place") == F.col("gid")
    kept = counted.filter(F.col("f") >= least)
    return landed(kept.select("place", "gid", *[F.when(first, F.col(c)).alias(c) for c in ("f", "lang", "word")]), "frequent")


def frequent_pairs(relation: DataFrame, least: int) -> DataFrame:
    """The pairs that occur ``least`` times over all chunks: (chunk, idx, gid) with packed
    indexes in a chunk and numbers, a row per block that has any, and (first, f, l, r) once
    for each pair, ``first`` being its number. A range's blocks hold all there is of its pairs."""

    def count(blocks: pa.Table) -> pa.Table:
        part = lambda c, f: np.concatenate([f(x) for x in blocks.column(c).to_pylist()])
        left, right, times = part("l", _unpack_sorted), part("r", _unpack), part("times", _unpack)
        first, chunk = (blocks.column(c).to_numpy() for c in ("first", "chunk"))
        sizes = np.array([int.from_bytes(x[1:5], "little") for x in blocks.column("l").to_pylist()])
        begin = np.cumsum(sizes) - sizes
        place = np.repeat((chunk << INDEX) + first - begin, sizes) + np.arange(len(left))
        order = np.lexsort((place, right, left))
        left, right, place, times = left[order], right[order], place[order], times[order]
        new = np.flatnonzero((np.diff(left, prepend=-1) != 0) | (np.diff(right, prepend=-1) != 0))
        f = np.add.reduceat(times, new)
        kept = np.repeat(f, np.diff([*new, len(left)])) >= least
        gid = np.repeat(place[new], np.diff([*new, len(left)]))[kept]
        one, f = new[f >= least], f[f >= least]
        firsts, place = place[one], place[kept]
        order = np.argsort(place)
        gid, place = gid[order], place[order]
        cut = np.flatnonzero(np.diff(place >> INDEX, prepend=-1))
        ends = [*cut[1:], len(place)] if len(cut) else []
        packed = lambda x: [_pack(x[a:b]) for a, b in zip(cut, ends, strict=True)]
        more, rest = len(one), len(cut)
        column = lambda x, y, kind: pa.concat_arrays([pa.array(x, kind), pa.array(y, kind)])
        none, nothing, number = [None] * rest, [None] * more, pa.int64()
        return pa.table(
            {"chunk": column(place[cut] >> INDEX, nothing, number),
             "idx": column(packed(place % (1 << INDEX)), nothing, pa.binary()), "gid": column(packed(gid), nothing, pa.binary()),
             "first": column(none, firsts, number),
             "f": column(none, f, number), "l": column(none, left[one], number), "r": column(none, right[one], number)}
        )

    blocks = relation.filter("range is not null").select("range", "chunk", "first", "l", "r", "times")
    found = blocks.groupBy("range").applyInArrow(count, "chunk long, idx binary, gid binary, first long, f long, l long, r long")
    return landed(found, "frequent")


def next_level(relation: DataFrame, groups: DataFrame, last: bool, n_ranges: int) -> DataFrame:
    """The join with the adjacent place, of what the frequent groups leave of a relation.
    ``groups``: (chunk, idx, gid), numbers or packed ones."""
    found = groups.groupBy("chunk").agg(F.collect_list(F.struct("idx", "gid")).alias("found"))
    chunks = relation.filter("at is not null").select("chunk", "lang", "counted", "at", "groups")
    schema = f"{_RELATION}, range long, first long, l binary, r binary, times binary"
    return chunks.join(found, "chunk").mapInArrow(_extend(last, n_ranges), schema)


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their query has ended: what follows reads landed tables."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of up to ``longest`` words that occur ``least`` times,
    and (lang, n), the number of words per language."""
    relation = landed(first_level(docs), "occurrences")
    sizes = relation.filter("place is not null").groupBy("lang").agg(F.sum("times").alias("n"))
    sizes = landed(sizes, "sizes")
    n_ranges = (sizes.agg(F.sum("n")).first()[0] or 0) // RANGE + 1
    words = frequent_words(relation, least)
    found = words.filter("place = gid").select("gid", "lang", F.array("word").alias("words"), "f")
    every = found.drop("gid")
    index = (F.col("place") % (1 << INDEX)).cast("int")
    groups = words.select(F.shiftright("place", INDEX).alias("chunk"), index.alias("idx"), "gid")
    for k in range(2, longest + 1):
        relation = landed(next_level(relation, groups, k == longest, n_ranges), "occurrences")
        pairs = frequent_pairs(relation, least)
        groups = pairs.filter("chunk is not null").select("chunk", "idx", "gid")
        left = found.select(F.col("gid").alias("l"), "lang", F.col("words").alias("head"))
        right = found.select(F.col("gid").alias("r"), F.slice("words", -1, 1).alias("tail"))
        longer = pairs.filter("first is not null").select(F.col("first").alias("gid"), "f", "l", "r")
        longer = longer.join(left, "l").join(right, "r")
        found = landed(longer.select("gid", "lang", F.concat("head", "tail").alias("words"), "f"), "phrases")
        every = every.unionByName(found.drop("gid"))
    return every, sizes


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def scores(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of phrases of two words or more: floor(1000 a n
    / (l r)) of the cut where it is lowest, the first of equals. Decimals of 38 digits."""
    named = phrases.select("lang", _phrase(F.col("words")).alias("phrase"), "words", "f")
    size = F.size("words")
    cuts = named.filter(size > 1).withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "phrase", size.alias("size"), F.col("f").alias("a"), "cut",
        _phrase(F.slice("words", F.lit(1), F.col("cut"))).alias("head"),
        _phrase(F.slice("words", F.col("cut") + 1, size - F.col("cut"))).alias("tail"),
    )
    left = named.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = named.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(sizes, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.withColumn("above", (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    both = both.withColumn("below", wide("l") * wide("r"))
    score = F.expr("cast(above div below as bigint)")
    lowest = both.groupBy("lang", "phrase", "size", "a", "n").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("at")
    )
    return lowest.select("lang", "phrase", "size", "a", "at.l", "at.r", "n", "at.score")


def maximal(candidates: DataFrame, phrases: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that no longer phrase of at least ``share`` percent of their count holds.

    Phrases one word longer decide: if a phrase two words longer is as frequent, so is the one
    between them."""
    size = F.size("words")
    inner = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    longer = phrases.filter(size > 2).select("lang", "f", F.explode(inner).alias("part"))
    longer = longer.select("lang", _phrase(F.col("part")).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    held = candidates.join(longer, ["lang", "phrase"], "left")
    return held.filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))).drop("longer")


def mine(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` collocations by
    score, then count, then phrase.

    Null texts and texts without words add nothing; null language is ``und``. Rows that
    repeat each count. A table without a frequent phrase of two words gives no row. Columns
    other than lang and text aren't read.
    """
    with _without_shuffle_files(docs.sparkSession):
        phrases, sizes = frequent_phrases(docs, longest, least)
    kept = maximal(scores(phrases, sizes), phrases, share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
