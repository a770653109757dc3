"""Substring dedup with difference-cover anchors.

A window of WINDOW words is removed where the same words also start a window in a document
with a smaller id. Instead of hashing every window, a first pass hashes shorter anchors, and
only at word positions whose remainder modulo PERIOD lies in the difference cover COVER. For
any two positions i and j there is a shift d < PERIOD that takes both into the cover, so two
equal windows always share an anchor at such a position. Only around anchors that more than
one document has are whole windows formed; a second pass finds the smallest document of each.

Texts are packed into chunks of a few MB once. A chunk sends its sorted distinct hashes by
hash range, and gets one bit back for each. A passage that a third of all documents share
costs one hash per chunk.

A chunk sends at most FAN pieces. If the table needs more ranges, hashes travel in levels: a
block of the first level takes a wide range from a group of chunks and keeps each hash once;
it sends its hashes on by narrower ranges to a block that stands for more chunks, until a
block holds its range of all chunks. Every level has as many blocks, so the pieces sent grow
with the table, not with its chunks times its ranges. Answers go back by the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Words, landed, mix, text_of, window_hashes

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
#: An anchor at shift d < PERIOD of a window still lies inside it.
ANCHOR = WINDOW - PERIOD + 1

#: Characters of a chunk (a longer text is a chunk of its own), and text bytes per range of
#: hashes: a range has about a million.
CHUNK, RANGE = 4 << 20, 16 << 20
#: Pieces that a chunk or block sends at most, each with 70 hashes or more of a full chunk:
#: one level does for 64 GB of texts, two for 256 TB. A level costs one more shuffle of the
#: hashes and lands them once.
FAN = 4096
#: Anchors are compared by 48 bits: one that is taken for another only forms windows that
#: the second pass finds to be unique.
ANCHOR_BITS = 48

NONE = np.iinfo(np.int64).max  # the id of a row without one: smaller than nothing


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int | None, bytes]] = []
    size, n = 0, 0
    partition = TaskContext.get().partitionId()

    def chunk():
        nonlocal n
        blob = zstandard.ZstdCompressor(level=3).compress(b"".join(t for _, t in held))
        row = {"chunk": (partition << 32) + n, "ids": [i for i, _ in held],
               "sizes": [len(t) for _, t in held], "n_bytes": size, "blob": blob}
        n += 1
        held.clear()
        return pa.RecordBatch.from_pylist([row], _CHUNK)

    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held.append((i, t.encode()))
            size += len(held[-1][1])
            if size >= CHUNK:
                yield chunk()
                size = 0
    if held:
        yield chunk()


_CHUNK = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("n_bytes", pa.int64()), ("blob", pa.binary())])


class Chunk:
    """The words of a chunk, and where each document's are."""

    def __init__(self, ids, sizes, blob: bytes):
        data = zstandard.ZstdDecompressor().decompress(blob)
        ends = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        self.texts = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        w = Words([t.decode() for t in self.texts])
        self.hashes, self.at = w.hashes, w.at
        self.n = np.diff(self.at)
        self.ids = np.array([NONE if i is None else i for i in ids], np.int64)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.local = np.arange(len(self.hashes)) - self.at[self.doc] if len(self.doc) else np.zeros(0, np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word positions in the cover whose anchor lies in a document of WINDOW words, and
        the anchors' hashes."""
        rest = self.n[self.doc] - self.local
        place = np.flatnonzero(
            np.isin(self.local % PERIOD, COVER) & (rest >= ANCHOR) & (self.n[self.doc] >= WINDOW)
        )
        return place, window_hashes(self.hashes, ANCHOR)[place] >> np.uint64(64 - ANCHOR_BITS)

    def anchor_set(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions, number of each one's hash, the distinct hashes, and whether more than
        one of the chunk's documents has a hash."""
        place, h = self.anchors()
        distinct, number = np.unique(h, return_inverse=True)
        doc = self.doc[place]
        low = np.full(len(distinct), NONE)
        high = np.full(len(distinct), -1)
        np.minimum.at(low, number, doc)
        np.maximum.at(high, number, doc)
        return place, number, distinct, low != high

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows around shared anchors, and their hashes."""
        step = np.zeros(len(self.hashes) + 1, np.int64)
        first = np.maximum(shared - PERIOD + 1, self.at[self.doc[shared]])
        last = np.minimum(shared, self.at[self.doc[shared] + 1] - WINDOW)
        ok = first <= last
        np.add.at(step, first[ok], 1)
        np.add.at(step, last[ok] + 1, -1)
        starts = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        return starts, window_hashes(self.hashes, WINDOW)[starts]

    def window_set(self, shared: np.ndarray):
        """Starts, number of each one's hash, the distinct hashes, and each one's smallest id."""
        starts, h = self.windows(shared)
        distinct, number = np.unique(h, return_inverse=True)
        least = np.full(len(distinct), NONE)
        np.minimum.at(least, number, self.ids[self.doc[starts]])
        return starts, number, distinct, least


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned values in as many bytes each as the largest one needs, one plane per byte."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def spread(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8").ravel()


@dataclass(frozen=True)
class Route:
    """How hashes travel: ``fan`` pieces per sender, ``levels`` of blocks.

    A block of level k stands for one of ``fan ** (levels - k)`` groups of chunks and one of
    ``fan ** k`` ranges. Groups and ranges are nested from level to level.
    """

    fan: int
    levels: int

    @classmethod
    def over(cls, n_ranges: int) -> Route:
        levels = 1
        while FAN**levels < n_ranges:
            levels += 1
        fan = 1
        while fan**levels < n_ranges:
            fan += 1
        return cls(fan, levels)

    def group_of(self, chunk: int) -> int:
        """A chunk's group at the first level; at the last, all chunks are one group."""
        drawn = int(mix(np.array([chunk], np.uint64))[0] >> np.uint64(32))
        return (drawn * self.fan ** (self.levels - 1)) >> 32

    def ranges_of(self, hashes: np.ndarray, bits: int, level: int) -> np.ndarray:
        return ((hashes >> np.uint64(bits - 32)) * np.uint64(self.fan**level)) >> np.uint64(32)

    def parent(self, block: int, level: int) -> int:
        """The group that takes a block's hashes at the next level."""
        return block // self.fan**level // self.fan


def pieces(route: Route, level: int, sender: int, group: int, distinct: np.ndarray, extra: np.ndarray, bits: int) -> list[dict]:
    """A row per block of ``level`` that gets any of the sorted hashes: their differences,
    and a number that goes with each."""
    part = route.ranges_of(distinct, bits, level)
    present, cuts = np.unique(part, return_index=True)
    rows = []
    for r, a, b in zip(present.tolist(), cuts, np.append(cuts, len(part))[1:], strict=True):
        steps = np.diff(distinct[a:b], prepend=np.uint64(0))
        base = int(extra[a:b].min())
        rows.append({"block": group * route.fan**level + r, "sender": sender, "hashes": squeeze(steps),
                     "base": base, "extra": squeeze((extra[a:b] - base).astype(np.uint64))})
    return rows


_SENT = pa.schema([("block", pa.int64()), ("sender", pa.int64()), ("hashes", pa.binary()),
                   ("base", pa.int64()), ("extra", pa.binary())])
SENT = "block long, sender long, hashes binary, base long, extra binary"
BITS = "sender long, block long, bits binary"
#: A block on the way: its own hashes, and for each sender the places of its hashes among
#: them and the bits that are known already.
MERGED = "block long, hashes binary, base long, extra binary, senders array<long>, places array<binary>, known array<binary>"


def _send_anchors(route: Route):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, distinct, several = Chunk(row["ids"], row["sizes"], row["blob"]).anchor_set()
                group = route.group_of(row["chunk"])
                sent = pieces(route, 1, row["chunk"], group, distinct, several.astype(np.int64), ANCHOR_BITS)
                yield pa.RecordBatch.from_pylist(sent, _SENT)

    return run


def _unpacked(hashes: bytes, base: int, extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(spread(hashes), dtype=np.uint64), spread(extra).astype(np.int64) + base


def _gather(f: pd.DataFrame):
    """All hashes that a block gets: the distinct ones, the place of each among them, the
    number that came with each, and the senders' cuts."""
    got = [_unpacked(*x) for x in zip(f["hashes"], f["base"], f["extra"], strict=True)]
    cuts = np.cumsum([0, *(len(h) for h, _ in got)])
    distinct, place = np.unique(np.concatenate([h for h, _ in got]), return_inverse=True)
    return distinct, place, np.concatenate([x for _, x in got]), cuts


def shared(place: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an anchor is in more than one document, per distinct anchor and per place."""
    yes = (np.bincount(place) > 1) | (np.bincount(place, several) > 0)
    return yes.astype(np.int64), yes[place]


def owned(place: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of each distinct window, and per place whether it is smaller than the
    sender's own."""
    owner = np.full(place.max() + 1, NONE)
    np.minimum.at(owner, place, least)
    return owner, owner[place] < least


def _cut_bits(yes: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    return [np.packbits(yes[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _answer(judge):
    """The last level: a block has its range of all chunks."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        _, place, extra, cuts = _gather(f)
        return pd.DataFrame({"sender": f["sender"], "block": f["block"], "bits": _cut_bits(judge(place, extra)[1], cuts)})

    return run


def _merge(judge):
    """A level on the way: what is known among a group of chunks, each hash once."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        distinct, place, extra, cuts = _gather(f)
        whole, known = judge(place, extra)
        base = int(whole.min())
        # A sender's hashes are sorted, so their places rise.
        places = [squeeze(np.diff(place[a:b], prepend=0).astype(np.uint64)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        row = {"block": f["block"].iloc[0], "hashes": squeeze(np.diff(distinct, prepend=np.uint64(0))), "base": base,
               "extra": squeeze((whole - base).astype(np.uint64)), "senders": f["sender"].tolist(),
               "places": places, "known": _cut_bits(known, cuts)}
        return pd.DataFrame([row])

    return run


def _pass_on(route: Route, level: int, bits: int):
    """A block of ``level`` sends its hashes to the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                distinct, extra = _unpacked(row["hashes"], row["base"], row["extra"])
                group = route.parent(row["block"], level)
                yield pa.RecordBatch.from_pylist(
                    pieces(route, level + 1, row["block"], group, distinct, extra, bits), _SENT
                )

    return run


_BITS = pa.schema([("sender", pa.int64()), ("block", pa.int64()), ("bits", pa.binary())])


def _hand_down(route: Route, level: int, bits: int):
    """A block of ``level`` has the next one's answers: its senders get theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                distinct, _ = _unpacked(row["hashes"], row["base"], row["extra"])
                yes = _bits(route, level + 1, row["answers"], distinct, bits)
                out = []
                for sender, places, known in zip(row["senders"], row["places"], row["known"], strict=True):
                    own = yes[np.cumsum(spread(places)).astype(np.int64)]
                    own |= np.unpackbits(np.frombuffer(known, np.uint8), count=len(own)).astype(bool)
                    out.append({"sender": sender, "block": row["block"], "bits": np.packbits(own).tobytes()})
                yield pa.RecordBatch.from_pylist(out, _BITS)

    return run


def _bits(route: Route, level: int, answers: list | None, distinct: np.ndarray, bits: int) -> np.ndarray:
    """The answers of all blocks of ``level``, in the order of the distinct hashes."""
    part = route.ranges_of(distinct, bits, level)
    yes = np.zeros(len(distinct), bool)
    for r in answers or []:
        own = np.uint64(r["block"] % route.fan**level)
        a, b = np.searchsorted(part, own, "left"), np.searchsorted(part, own, "right")
        yes[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a).astype(bool)
    return yes


def _by_sender(answers: DataFrame, sender: str, name: str) -> DataFrame:
    return answers.groupBy(F.col("sender").alias(sender)).agg(F.collect_list(F.struct("block", "bits")).alias(name))


def judged(sent: DataFrame, judge, bits: int, route: Route, label: str) -> DataFrame:
    """(sender, block, bits) for the pieces that chunks sent to the first level's blocks."""
    blocks = []
    for level in range(1, route.levels):
        merged = landed(sent.groupBy("block").applyInPandas(_merge(judge), MERGED), f"{label}_blocks")
        blocks.append((level, merged))
        sent = merged.select("block", "hashes", "base", "extra").mapInArrow(_pass_on(route, level, bits), SENT)
    answers = landed(sent.groupBy("block").applyInPandas(_answer(judge), BITS), label)
    for level, merged in reversed(blocks):
        told = merged.join(_by_sender(answers, "block", "answers"), "block")
        answers = landed(told.mapInArrow(_hand_down(route, level, bits), BITS), label)
    return answers


def _send_windows(route: Route):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["sizes"], row["blob"])
                place, number, distinct, _ = c.anchor_set()
                several = _bits(route, 1, row["anchors"], distinct, ANCHOR_BITS)
                _, _, distinct, least = c.window_set(place[several[number]])
                group = route.group_of(row["chunk"])
                yield pa.RecordBatch.from_pylist(pieces(route, 1, row["chunk"], group, distinct, least, 64), _SENT)

    return run


def _remove(route: Route):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["sizes"], row["blob"])
                place, number, distinct, _ = c.anchor_set()
                several = _bits(route, 1, row["anchors"], distinct, ANCHOR_BITS)
                starts, number, distinct, least = c.window_set(place[several[number]])
                elsewhere = _bits(route, 1, row["windows"], distinct, 64)
                own = c.ids[c.doc[starts]]
                # NONE is after every id and before none.
                gone = starts[elsewhere[number] | (least[number] < own)]
                step = np.zeros(len(c.hashes) + 1, np.int64)
                np.add.at(step, gone, 1)
                np.add.at(step, gone + WINDOW, -1)
                removed = np.cumsum(step[:-1]) > 0
                kept, counts = [], []
                for i, text in enumerate(c.texts):
                    words, mask = text.split(), removed[c.at[i] : c.at[i + 1]]
                    counts.append(int(mask.sum()))
                    if counts[-1]:
                        words = [w for w, m in zip(words, mask.tolist(), strict=True) if not m]
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(c.n), pa.array(counts, pa.int64()), pa.array(kept, pa.string())],
                    schema=schema,
                )

    return run


def dedup(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, text) per row of ``docs``; text: the words that are left,
    joined by one space.

    Null text has no words. Windows are judged on the input. Rows that repeat a doc_id
    remove nothing from each other. A row with null doc_id loses what any document has and
    takes nothing from others. An empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc_id"), text_of("text").alias("text"))
    chunks = own.mapInArrow(_pack, "chunk long, ids array<long>, sizes array<long>, n_bytes long, blob binary")
    chunks = landed(chunks, "chunks")
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    route = Route.over(int(max(1, spark.sparkContext.defaultParallelism, -(-size // RANGE))))

    anchors = judged(chunks.mapInArrow(_send_anchors(route), SENT), shared, ANCHOR_BITS, route, "anchors")
    marked = chunks.join(_by_sender(anchors, "chunk", "anchors"), "chunk", "left")
    windows = judged(marked.mapInArrow(_send_windows(route), SENT), owned, 64, route, "windows")
    marked = marked.join(_by_sender(windows, "chunk", "windows"), "chunk", "left")
    return marked.mapInArrow(_remove(route), "doc_id long, n_words long, n_removed long, text string")
