"""Chat formatting by columnar byte assembly.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts, ``<``,
any backslashes and ``|`` get one backslash more, so no control string is left in them and
taking one backslash off gives the text back.

A batch of turns is assembled without a loop over them: segment lengths give cumulative
offsets, offsets give the place of every byte, and headers, texts and ends are copied into
one buffer that is the data of the Arrow string column itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = b"<|im_start|>", b"<|im_end|>\n"
_ESCAPE, _UNESCAPE = re.compile(rb"<(\\*)\|"), re.compile(rb"<\\(\\*)\|")

#: A conversation is held in memory up to this many bytes; a longer one comes in parts.
PART_BYTES = 32 << 20

FORMATTED = "conv_id long, part int, formatted string, loss array<struct<start:int,stop:int>>, n_turns long"


def escape(data: bytes) -> bytes:
    return _ESCAPE.sub(rb"<\\\1|", data)


def unescape(data: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", data)


def role_bytes(role: str) -> bytes:
    """A role on one line: backslash and line feed are written as \\\\ and \\n."""
    return escape(role.encode().replace(b"\\", b"\\\\").replace(b"\n", b"\\n"))


def role_of(data: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], unescape(data))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns, the n + 1 offsets of turns, start and stop of their texts."""
    n = len(texts)
    texts = texts.cast(pa.large_string())
    _, raw_at, raw = texts.buffers()
    raw_at = np.frombuffer(raw_at, np.int64, n + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(raw, np.uint8)[raw_at[0] : raw_at[-1]] if raw is not None else np.zeros(0, np.uint8)
    raw_at = raw_at - raw_at[0]

    # Bytes before which a backslash goes in; a match across two texts is none.
    hits = np.array([(m.start(), m.end()) for m in _ESCAPE.finditer(data)], np.int64).reshape(-1, 2)
    row = np.searchsorted(raw_at, hits[:, 0], "right") - 1
    own = hits[:, 1] <= raw_at[row + 1]
    bars, row = hits[own, 1] - 1, row[own]
    added = np.bincount(row, minlength=n).astype(np.int64)

    codes = roles.dictionary_encode()
    heads = [START + role_bytes(r) + b"\n" for r in codes.dictionary.to_pylist()]
    which = codes.indices.to_numpy(zero_copy_only=False)
    head_len = np.array([len(h) for h in heads], np.int64)[which] if n else np.zeros(0, np.int64)
    text_len = np.diff(raw_at) + added
    at = np.zeros(n + 1, np.int64)
    np.cumsum(head_len + text_len + len(END), out=at[1:])
    start = at[:-1] + head_len
    stop = start + text_len

    out = np.empty(at[-1], np.uint8)
    for code, head in enumerate(heads):
        where = at[:-1][which == code]
        out[where[:, None] + np.arange(len(head))] = np.frombuffer(head, np.uint8)
    place = np.repeat(start - raw_at[:-1], np.diff(raw_at)) + np.arange(len(data))
    if len(bars):
        # Within a text, each byte moves on by the backslashes put in before it.
        shift = np.zeros(len(data) + 1, np.int64)
        np.add.at(shift, bars, 1)
        shift = np.cumsum(shift)[:-1]
        first = np.concatenate([[0], np.cumsum(added)])[:-1]
        place += shift - np.repeat(first, np.diff(raw_at))
        out[place[bars] - 1] = ord("\\")
    out[place] = data
    out[stop[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, at, start, stop


def _formatted(table: pa.Table, part: int) -> pa.RecordBatch:
    """One row per run of equal conv_id in a table sorted by it."""
    ids = table.column("conv_id").to_numpy(zero_copy_only=False)
    nulls = table.column("conv_id").is_null().to_numpy(zero_copy_only=False)
    ids = np.where(nulls, 0, ids).astype(np.int64)
    roles = table.column("role").combine_chunks()
    out, at, start, stop = assemble(roles, table.column("text").combine_chunks())
    n = len(ids)
    new = np.ones(n, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])
    first = np.flatnonzero(new)
    bounds = np.append(first, n)
    # Code points before each byte: bytes that don't continue a character.
    points = np.zeros(len(out) + 1, np.int64)
    np.cumsum((out & 0xC0) != 0x80, out=points[1:])
    masked = np.flatnonzero(np.array([r == "assistant" for r in roles.to_pylist()], bool))
    run = np.searchsorted(first, masked, "right") - 1
    zero = points[at[first]][run] if len(masked) else np.zeros(0, np.int64)
    spans = pa.StructArray.from_arrays(
        [
            pa.array((points[start[masked]] - zero).astype(np.int32)),
            pa.array((points[stop[masked]] - zero).astype(np.int32)),
        ],
        ["start", "stop"],
    )
    loss_at = np.searchsorted(masked, bounds).astype(np.int32)
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at[bounds]), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[first], mask=nulls[first]),
            pa.array(np.where(np.arange(len(first)) == 0, part, 0).astype(np.int32)),
            text,
            pa.ListArray.from_arrays(pa.array(loss_at), spans),
            pa.array(np.diff(bounds)),
        ],
        ["conv_id", "part", "formatted", "loss", "n_turns"],
    )


def _format_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Format sorted turns; the last conversation of a batch waits for its next turns."""
    held, part, flushed = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            same = table.column("conv_id")[0] == held.column("conv_id")[-1]
            part = part if same or not flushed else 0
            table = pa.concat_tables([held.filter(pa.array([not flushed] * held.num_rows)), table])
        ids = table.column("conv_id").to_pylist()
        last = len(ids) - 1
        while last and ids[last - 1] == ids[-1]:
            last -= 1
        if last:
            yield _formatted(table.slice(0, last), part)
            table, part = table.slice(last), 0
        held, flushed = table, table.nbytes > PART_BYTES
        if flushed:
            yield _formatted(held, part)
            held, part = held.slice(held.num_rows - 1), part + 1
    if held is not None and not flushed:
        yield _formatted(held, part)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: text, spans of the loss mask in code points, turns.

    Turns go by ``turn`` (null first), ties by role and text; equal rows are all kept. Null
    text or role is empty. Rows with null conv_id make one conversation. Only assistant
    texts are under the mask. A conversation of over PART_BYTES comes as consecutive rows
    with part 0, 1, ... An empty table gives no row; other columns are not read.
    """
    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sort = ["conv_id", "turn", "role", "text"]
    return own.repartition("conv_id").sortWithinPartitions(*sort).mapInArrow(_format_sorted, FORMATTED)


def parse(data: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted conversation; raises where it is none."""
    turns, at = [], 0
    while at < len(data):
        line, end = data.find(b"\n", at), data.find(END, at)
        if not data.startswith(START, at) or line < 0 or end < line:
            raise ValueError(f"no turn at byte {at}")
        turns.append((role_of(data[at + len(START) : line]), unescape(data[line + 1 : end])))
        at = end + len(END)
    return turns


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest each conversation; parts of one follow each other."""
    rows, now = [], None
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def close():
        conv, n, turns, chars, loss, total = now
        rows.append(dict(zip(schema.names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total), strict=True)))

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] == 0:
                if now:
                    close()
                now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text = row["formatted"]
            for role, said in parse(text.encode()):
                now[2].update(b"%s\n%s\n" % (role, said))
                now[1] += 1
            for span in row["loss"]:
                said = unescape(text[span["start"] : span["stop"]].encode())
                now[3] += len(said.decode())
                now[4].update(said)
            now[5] += len(text)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows.clear()
    if now:
        close()
        yield pa.RecordBatch.from_pylist(rows, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests read from the formatted text and its mask alone."""
    return formatted.mapInArrow(_read, READ)
