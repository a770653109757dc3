"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

Test items are cut into entries of at most ENTRY words; an entry's BM25 impacts are divided
by their sum, so an entry scores 1 for a passage that holds all its words. Passages are
overlapping windows over every whole text, long enough to hold any entry entirely. Each
passage queries the index; block-max WAND returns all entries at or above the threshold.
A document is contaminated by an item if, beyond that score, its own word 5-grams cover the
item's question and answer or a part of the whole item; an item of fewer than SHORT words
must stand in it word for word.

Entries are dealt to shards of about SHARD. Executors build an index per shard and write it
to the shared folder; nothing of the benchmark passes through the driver. A task hashes its
texts once, HELD characters at a time, and takes them through the shards' files one after
another. So neither side is ever paired up in a shuffle, and memory holds one shard and one
portion of texts. Number, mean size and document frequencies are those of all entries, so
scores don't depend on shards.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Words, landed, slices, text_of, window_hashes
from tidelog.session import run_dir

#: Words of an index entry at most; a passage has twice as many and moves on by as many.
ENTRY = 48
K1, B = 1.2, 0.75
#: Entries of a block share one upper bound per term.
BLOCK = 4
#: Least share of an entry's own score.
THRESHOLD = 0.5
#: The most frequent terms are left aside while they give no entry more than this.
COMMON = 0.05
#: Least share of the question's and of the answer's 5-grams that a document must hold.
QUESTION, ANSWER, GRAM = 0.5, 0.3, 5
#: Or this share of the whole item's; where no question and answer are told apart by a question
#: mark, a smaller one.
WHOLE, PART = 0.8, 0.5
#: An item of fewer words must occur whole, in order.
SHORT = 2 * GRAM
#: Entries of one shard: its index has a few dozen MB at most. Characters of the texts that a
#: task takes through all shards at a time.
SHARD, HELD = 20_000, 16 << 20

_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def normal(data: np.ndarray) -> np.ndarray:
    """ASCII punctuation to blanks; case is folded before, in all alphabets."""
    return np.where(_PUNCT[data], np.uint8(32), data)


def question_answer(text: str) -> tuple[str, str]:
    """The answer follows the last question mark, else the last line break, else it is the
    last quarter of the words."""
    for mark in ("?", "\n"):
        head, found, tail = text.strip().rpartition(mark)
        if found and head.strip() and tail.strip():
            return head + found, tail
    words = text.split()
    cut = len(words) - max(1, len(words) // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


def asks(text: str) -> bool:
    """Whether a question mark tells a question and an answer apart."""
    head, _, tail = text.strip().rpartition("?")
    return bool(head.strip() and tail.strip())


def grams(words: np.ndarray) -> tuple[np.ndarray, int]:
    """Distinct hashes of n-grams and n: 5, or the number of words where they are fewer."""
    n = min(GRAM, max(1, len(words)))
    return np.unique(window_hashes(words, n)), n


def share(words: np.ndarray, wanted: np.ndarray, n: int) -> float:
    """The part of the wanted n-grams that a text holds."""
    return float(np.isin(wanted, window_hashes(words, n)).mean()) if len(wanted) else 1.0


def items_of(item_id: int, text: str) -> tuple:
    """Entries, and the 5-grams of question, answer and whole item."""
    q, a = question_answer(text)
    w = Words([text.lower(), q.lower(), a.lower()], normal)
    whole, question, answer = (w.hashes[w.at[i] : w.at[i + 1]] for i in range(3))
    parts = max(1, math.ceil(len(whole) / ENTRY))
    entries = [e for e in np.array_split(whole, parts) if len(e)]
    if len(whole) < SHORT:  # the run of all its words is what a document must hold
        run = window_hashes(whole, max(1, len(whole))), max(1, len(whole))
        return entries, run, run, run
    return entries, grams(question), grams(answer), grams(whole)


class Index:
    """Inverted index of a shard: per term, entries and impacts; per term and block, the
    largest impact. ``whole``: number and mean size of the entries of all shards, sorted terms
    and their document frequencies there; None if this is the only shard."""

    def __init__(self, items: list[tuple[int, str]], whole: tuple | None = None):
        self.items, self.entry_item, terms = [], [], []
        for item_id, text in items:
            parts, *wanted = items_of(item_id, text)
            for e in parts:
                terms.append(e)
                self.entry_item.append(len(self.items))
            self.items.append((item_id, *wanted, WHOLE if asks(text) else PART))
        # Entries that share their most frequent words (a language, a subject) become
        # neighbours, so that a block's bounds are close.
        every, times = np.unique(np.concatenate(terms), return_counts=True) if terms else (np.zeros(0, np.uint64), [])
        rank = np.empty(len(every), np.int64)
        rank[np.lexsort((every, -np.asarray(times)))] = np.arange(len(every))
        keys = [tuple(np.unique(rank[np.searchsorted(every, e)])[:8]) for e in terms]
        order = sorted(range(len(terms)), key=lambda i: (keys[i], i))
        terms = [terms[i] for i in order]
        self.entry_item = [self.entry_item[i] for i in order]
        entries = [np.full(len(e), i, np.int64) for i, e in enumerate(terms)]
        n = len(self.entry_item)
        term = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
        entry = np.concatenate(entries) if entries else np.zeros(0, np.int64)
        self.vocabulary, code = np.unique(term, return_inverse=True)
        pair, tf = np.unique(code * max(n, 1) + entry, return_counts=True)
        code, entry = pair // max(n, 1), pair % max(n, 1)
        size = np.bincount(entry, tf, minlength=n)
        df = np.bincount(code, minlength=len(self.vocabulary))
        n_all, mean, df_all = n, size.mean() if n else 1, df
        if whole is not None:
            n_all, mean, terms_all, df_all = whole
            df_all = df_all[np.searchsorted(terms_all, self.vocabulary)]
        idf = np.log(1 + (n_all - df_all + 0.5) / (df_all + 0.5))
        norm = K1 * (1 - B + B * size / max(1e-9, mean))
        impact = idf[code] * tf * (K1 + 1) / (tf + norm[entry])
        impact = impact / np.bincount(entry, impact, minlength=n)[entry]
        self.n_entries, self.n_blocks = n, -(-n // BLOCK)
        self.first = np.searchsorted(code, np.arange(len(self.vocabulary) + 1))
        self.entry, self.impact = entry, impact
        blocks, where = np.unique(code * max(1, self.n_blocks) + entry // BLOCK, return_inverse=True)
        self.block_max = np.zeros(len(blocks))
        np.maximum.at(self.block_max, where, impact)
        self.block = blocks % max(1, self.n_blocks)
        self.block_first = np.searchsorted(blocks // max(1, self.n_blocks), np.arange(len(self.vocabulary) + 1))
        self.term_max = np.zeros(len(self.vocabulary))
        np.maximum.at(self.term_max, code, impact)
        # Terms by falling frequency, as long as together they give no entry over COMMON:
        # a passage needs the rest of the threshold from the other, essential terms.
        order = np.argsort(-df, kind="stable")
        gained = np.zeros(n)
        self.essential = np.ones(len(self.vocabulary), bool)
        self.rest = THRESHOLD - 1e-9
        for t in order:
            a, b = self.first[t], self.first[t + 1]
            gained[entry[a:b]] += impact[a:b]
            if gained[entry[a:b]].max() > COMMON:
                break
            self.essential[t] = False
            self.rest = THRESHOLD - 1e-9 - gained.max()
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.vocabulary[self.essential] & np.uint64(0xFFFF)).astype(np.int64)] = True

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for a word no entry has."""
        at = np.searchsorted(self.vocabulary, words)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == words, at, -1)

    def essentials(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are essential terms, and their term numbers."""
        place = np.flatnonzero(self.low[(words & np.uint64(0xFFFF)).astype(np.int64)])
        code = self.codes(words[place])
        ok = (code >= 0) & self.essential[code]
        return place[ok], code[ok]

    def bound(self, passage: np.ndarray, term: np.ndarray, n: int, entries: bool, need: float) -> np.ndarray:
        """Passages 0 .. n - 1 that may reach the threshold, from sorted pairs of passage and
        term: for some block (or, finer, some entry) the largest impacts of the passage's
        terms sum to ``need``. This is the bound of block-max WAND, for many passages at once.
        """
        first, unit, value, units = (
            (self.first, self.entry, self.impact, self.n_entries)
            if entries
            else (self.block_first, self.block, self.block_max, self.n_blocks)
        )
        best = np.zeros(n)
        step = max(1, (1 << 20) // max(1, units))
        cuts = np.searchsorted(passage, np.arange(0, n + step, step))
        for k in range(len(cuts) - 1):
            p, t = passage[cuts[k] : cuts[k + 1]] - k * step, term[cuts[k] : cuts[k + 1]]
            if not len(p):
                continue
            times = first[t + 1] - first[t]
            ends = np.cumsum(times)
            flat = np.arange(ends[-1]) + np.repeat(first[t] - (ends - times), times)
            m = min(step, n - k * step)
            sums = np.bincount(np.repeat(p * units, times) + unit[flat], value[flat], minlength=m * units)
            best[k * step : k * step + m] = sums.reshape(m, units).max(axis=1)
        return np.flatnonzero(best >= need)

    def wand(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All (entry, score) of a passage at or above the threshold, by block-max WAND."""
        need = THRESHOLD - 1e-9
        lists = [[int(self.first[t]), int(self.first[t + 1]), int(t)] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda x: self.entry[x[0]])
            # Pivot: the first list at which the terms' upper bounds can reach the threshold.
            bound, pivot = 0.0, None
            for i, (_, _, t) in enumerate(lists):
                bound += self.term_max[t]
                if bound >= need:
                    pivot = i
                    break
            if pivot is None:
                return found
            at = self.entry[lists[pivot][0]]
            while pivot + 1 < len(lists) and self.entry[lists[pivot + 1][0]] == at:
                pivot += 1
            block = at // BLOCK
            shallow = 0.0
            for _, _, t in lists[: pivot + 1]:
                a, b = self.block_first[t], self.block_first[t + 1]
                k = a + np.searchsorted(self.block[a:b], block)
                shallow += self.block_max[k] if k < b and self.block[k] == block else 0.0
            if shallow < need:
                # No entry of this block up to the next list's can do: all lists move past.
                to = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    to = min(to, self.entry[lists[pivot + 1][0]])
                to = max(to, at + 1)
            elif self.entry[lists[0][0]] == at:
                score = sum(self.impact[x[0]] for x in lists[: pivot + 1])
                if score >= need:
                    found.append((int(at), float(score)))
                to = at + 1
            else:
                to = at
            moved = []
            for i, x in enumerate(lists):
                if i <= pivot and self.entry[x[0]] < to:
                    x[0] += int(np.searchsorted(self.entry[x[0] : x[1]], to))
                if x[0] < x[1]:
                    moved.append(x)
            lists = moved
        return found

    def matches(self, w: Words) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item_id, score, question share, answer share) of each verified pair."""
        if not len(self.vocabulary):
            return
        sizes = np.diff(w.at)
        # Passage j of a text has words j * ENTRY .. j * ENTRY + 2 * ENTRY.
        counts = np.maximum(1, -(-sizes // ENTRY) - 1)
        base = np.concatenate([[0], np.cumsum(counts)])
        place, code = self.essentials(w.hashes)
        text = np.searchsorted(w.at, place, "right") - 1
        part = (place - w.at[text]) // ENTRY
        keys = []
        for shift in (0, 1):
            j = part - shift
            ok = (j >= 0) & (j < counts[text])
            keys.append((base[text[ok]] + j[ok]) * len(self.vocabulary) + code[ok])
        keys = np.unique(np.concatenate(keys))
        passage, term = keys // len(self.vocabulary), keys % len(self.vocabulary)
        best: dict[tuple[int, int], float] = {}
        hopeful = self.bound(passage, term, int(base[-1]), False, self.rest)
        owners = np.searchsorted(base, hopeful, "right") - 1
        starts = w.at[owners] + (hopeful - base[owners]) * ENTRY
        stops = np.minimum(starts + 2 * ENTRY, w.at[owners + 1])
        # With all their terms, entry by entry, few of these are left.
        which = np.repeat(np.arange(len(hopeful)), stops - starts)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(stops - starts) - (stops - starts), stops - starts)
        code = self.codes(w.hashes[starts[which] + inside])
        pairs = np.unique(which[code >= 0] * len(self.vocabulary) + code[code >= 0])
        which, term = pairs // len(self.vocabulary), pairs % len(self.vocabulary)
        for p in self.bound(which, term, len(hopeful), True, THRESHOLD - 1e-9):
            a, b = np.searchsorted(which, [p, p + 1])
            owner = int(owners[p])
            for entry, score in self.wand(term[a:b]):
                key = owner, self.entry_item[entry]
                best[key] = max(best.get(key, 0.0), score)
        own: dict[int, np.ndarray] = {}
        for (owner, item), score in sorted(best.items()):
            if owner not in own:
                own[owner] = w.hashes[w.at[owner] : w.at[owner + 1]]
            item_id, q, a, whole, enough = self.items[item]
            q_share, a_share, all_share = (share(own[owner], *g) for g in (q, a, whole))
            if (q_share >= QUESTION and a_share >= ANSWER) or all_share >= enough:
                yield owner, item_id, score, q_share, a_share


def words_of(texts: list[str]) -> Words:
    return Words([t.lower() for t in texts], normal)


_LEAK = "doc_id long, item_id long, score double, question_share double, answer_share double"


def _match(folder: str, n_shards: int):
    names = [c.split()[0] for c in _LEAK.split(", ")]

    def read(shard: int) -> Index | None:
        store, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/{shard}.index"
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return None  # no entry fell into this shard
        with store.open_input_stream(path) as file:
            index = Index.__new__(Index)
            index.__dict__.update(pickle.loads(file.read()))
            return index

    def through(held: list[tuple[list, Words]], only: list) -> Iterator[pa.RecordBatch]:
        for shard in range(n_shards):
            index = only[0] if only else read(shard)
            if n_shards == 1:
                only[:] = [index]  # a single shard is read once per task
            if index is None:
                continue
            for ids, w in held:
                rows = [(ids[i], *rest) for i, *rest in index.matches(w)]
                if rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), [pa.int64()] * 2 + [pa.float64()] * 3)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, only = [], 0, []
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in slices(texts):
                held.append((ids[a:b], words_of(texts[a:b])))
                size += sum(map(len, texts[a:b]))
                if size >= HELD or n_shards == 1:
                    yield from through(held, only)
                    held, size = [], 0
        if held:
            yield from through(held, only)

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, number of entries with it, 0) of a batch; term null: (entries, words)."""
    for batch in batches:
        found: dict[int, list[np.ndarray]] = {}
        for s, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found.setdefault(s, []).extend(items_of(0, text)[0])
        for s, entries in found.items():
            if not entries:
                continue
            term, n = np.unique(np.concatenate([np.unique(e) for e in entries]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s] * (len(term) + 1), pa.int64()), pa.array([None, *term.view(np.int64)], pa.int64()),
                 pa.array([len(entries), *n], pa.int64()), pa.array([sum(map(len, entries))] + [0] * len(term), pa.int64())],
                ["shard", "term", "n", "words"],
            )


def _build(folder: str, n: int, mean: float):
    """Index of a shard's items, written under a name that only its shard decides: an attempt
    of the task that is run again puts the same file there."""

    def run(key: tuple, items: pd.DataFrame, frequencies: pd.DataFrame) -> pd.DataFrame:
        own = sorted(zip(items["item_id"].astype(object), items["text"]), key=lambda x: (pd.isna(x[0]), x))
        term = frequencies["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(term)
        rows = [(None if pd.isna(i) else int(i), t) for i, t in own]
        index = Index(rows, (n, mean, term[order], frequencies["df"].to_numpy()[order]))
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        attempt = f"{root}/_{key[0]}-{uuid.uuid4().hex}"
        with store.open_output_stream(attempt) as file:
            file.write(pickle.dumps(index.__dict__))
        store.move(attempt, f"{root}/{key[0]}.index")
        return pd.DataFrame({"shard": [key[0]]})

    return run


def build(items: DataFrame, folder: str) -> None:
    """An index per shard of ``items`` (shard, item_id, text) in the folder. Entries, words
    and document frequencies are counted over all shards first."""
    counts = landed(items.select("shard", "text").mapInArrow(_terms, "shard long, term long, n long, words long"), "terms")
    total = counts.filter("term is null").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    n, words = total["n"] or 0, total["words"] or 0
    counts = counts.filter("term is not null")
    df = counts.groupBy("term").agg(F.sum("n").alias("df"))
    df = counts.select("shard", "term").distinct().join(df, "term").select("shard", "term", "df")
    built = items.groupBy("shard").cogroup(df.groupBy("shard")).applyInPandas(_build(folder, n, words / max(1, n)), "shard long")
    landed(built, "shards")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share) of every leak.

    Null and blank texts match nothing, on either side; items without words are no items.
    Repeated rows are reported as often as they come; items with equal text each match. An
    empty table on either side gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc_id"), text_of("text").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text"))
    items = items.filter(F.trim("text") != "")
    # A shard's entries are bounded by its words, whatever the number of items.
    words = items.select(F.sum(F.greatest(F.lit(1), F.ceil(F.octet_length("text") / (2 * ENTRY)))).alias("n"))
    n_shards = max(1, -(-int(words.first()["n"] or 0) // SHARD))
    folder = run_dir(spark, "index")
    build(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards))), folder)
    return own.mapInArrow(_match(folder, n_shards), _LEAK)
