"""Shared folder, landed tables, array hashing of words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import run_dir

# Words are runs of anything but ASCII white space, as in the query contracts.
WORD = r"[^\x20\x09-\x0D]+"


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, and a lost
    executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_of(column: str | Column) -> Column:
    """The text, empty for null."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit(""))


# ---- array hashing, used inside tasks ----

_RNG = np.random.RandomState(20240229)
#: A random 64-bit value per byte, so that similar bytes have unrelated values.
_BYTE = _RNG.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_STEP_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (a bijection in which every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        step = step * step
        done += take
    return out


#: Bytes hashed at a time; a longer text is cut at white space, so memory stays bounded.
PIECE = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1024, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        with np.errstate(over="ignore"):
            _POWERS[size] = _powers(_STEP, size), _powers(_STEP_INV, size)
    return _POWERS[size]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are no ASCII white space."""
    outside = np.ones(len(data) + 2, bool)
    outside[1:-1] = is_space(data)
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, by differences of a running polynomial sum.

    The sum at byte i holds value(b_j) * STEP**j over j < i; a word's difference is shifted
    back to exponent 0, so a word has the same hash wherever it stands.
    """
    out = np.empty(len(starts), np.uint64)
    done = 0
    with np.errstate(over="ignore"):
        while done < len(starts):
            base = starts[done]
            upto = max(done + 1, int(np.searchsorted(ends, base + PIECE, "right")))
            a, b = starts[done:upto] - base, ends[done:upto] - base
            n = int(b[-1])
            up, back = _tables(n)
            run = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[data[base : base + n]] * up[:n], out=run[1:])
            own = (run[b] - run[a]) * back[a]
            out[done:upto] = mix(own + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            done = upto
    return out


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = total * np.uint64(0xD1342543DE82EF95) + words[k : k + n]
        return mix(total + np.uint64(width))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z on bytes; multi-byte characters have no such bytes."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def slices(texts: list, limit: int = 2 << 20):
    """(first, past last) of runs of texts with up to ``limit`` characters each, or one text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > first and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


class Words:
    """Words of several texts, hashed together. Words of text i are at[i] .. at[i + 1]."""

    def __init__(self, texts: list[str], change=None):
        parts = [(t or "").encode() for t in texts]
        joined = np.frombuffer(b"\n".join(parts), np.uint8)
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])  # of each text in the joined bytes
        self.raw = joined
        self.data = change(joined) if change else joined
        self.starts, self.ends = word_bounds(self.data)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.at = np.searchsorted(self.starts, self.begin)
