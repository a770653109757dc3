"""Decoding of logical replication messages into a change feed.

Input rows: ``slot, seq, lsn, payload`` with the message bytes; ``seq`` numbers the
messages of a slot. Payloads are read once (``scan``): heads and layouts by Spark
expressions, tuples in Arrow batches of the same stage, the result landed. What depends on
earlier messages, namely the table layout and the transaction's commit time, is carried
forward along ``seq`` in chunks, from small summaries of the landed heads; no task sees a
whole slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.cells import failed_cast, try_typed
from tidelog.functions.lsn import from_epoch_2000
from tidelog.operators.ordered import CHUNK, ROWS_PER_CHUNK, dense_chunks
from tidelog.session import run_dir
from tidelog.spec import TableSpec

# Message kinds of the protocol (first byte).
BEGIN, COMMIT, RELATION = "B", "C", "R"
INSERT, UPDATE, DELETE, TRUNCATE = "I", "U", "D", "T"
CHANGES = (INSERT, UPDATE, DELETE)
KNOWN = (BEGIN, COMMIT, RELATION, *CHANGES, TRUNCATE)
# Cell kinds of a tuple.
NULL_CELL, UNSENT_CELL, TEXT_CELL = "n", "u", "t"
CELL_KINDS = (NULL_CELL, UNSENT_CELL, TEXT_CELL)
# Tags of an old tuple (key only, or the whole old row).
OLD_TAGS = ("K", "O")
NEW_TAG = "N"

# A table layout lists, per column, a flag byte, a zero-terminated name, a 32-bit type
# number and a 32-bit type modifier.
_LAYOUT = """
aggregate(
  sequence(1, {n}),
  named_struct('at', {start} + 2,
    'cols', cast(array() as array<struct<name:string,oid:bigint,typmod:bigint,is_key:boolean>>)),
  (acc, i) -> named_struct(
    'at', acc.at + 10 + octet_length(substring_index(cast(substring({p}, acc.at + 1) as string), '\\0', 1)),
    'cols', array_append(acc.cols, named_struct(
      'name', substring_index(cast(substring({p}, acc.at + 1) as string), '\\0', 1),
      'oid', cast(conv(hex(substring({p}, acc.at + 2
          + octet_length(substring_index(cast(substring({p}, acc.at + 1) as string), '\\0', 1)), 4)), 16, 10) as bigint),
      'typmod', cast(cast(conv(hex(substring({p}, acc.at + 6
          + octet_length(substring_index(cast(substring({p}, acc.at + 1) as string), '\\0', 1)), 4)), 16, 10) as bigint)
          - if(substring({p}, acc.at + 6
          + octet_length(substring_index(cast(substring({p}, acc.at + 1) as string), '\\0', 1)), 1) >= X'80', 4294967296, 0) as bigint),
      'is_key', substring({p}, acc.at, 1) = X'01')))
)
"""


def _uint(start: str, n: int) -> Column:
    return F.expr(f"cast(conv(hex(substring(payload, {start}, {n})), 16, 10) as bigint)")


def _int64(start: str) -> Column:
    return F.expr(f"cast(conv(hex(substring(payload, {start}, 8)), 16, -10) as bigint)")


def with_kind(messages: DataFrame) -> DataFrame:
    """Add ``kind``; a byte outside the protocol, or a DELETE without an old tuple, fails
    the job."""
    kind = F.expr("cast(substring(payload, 1, 1) as string)")
    tag = F.expr("cast(substring(payload, 6, 1) as string)")
    unknown = F.concat(
        F.lit("unknown replication message "), F.hex(F.expr("substring(payload, 1, 1)"))
    )
    no_old = F.lit("DELETE message without an old tuple")
    checked = (
        F.when(~kind.isin(*KNOWN), F.raise_error(unknown).cast("string"))
        .when((kind == DELETE) & ~tag.isin(*OLD_TAGS), F.raise_error(no_old).cast("string"))
        .otherwise(kind)
    )
    return messages.withColumn("kind", checked)


def heads(messages: DataFrame) -> DataFrame:
    """Changes, transaction starts and layouts without their cells: kind, table number,
    commit time, and what a layout message announces."""
    m = with_kind(messages).filter(F.col("kind").isin(BEGIN, RELATION, *CHANGES))
    announced = F.col("kind") == RELATION
    text = "cast(substring(payload, 6) as string)"
    m = m.withColumn("namespace", F.when(announced, F.expr(f"substring_index({text}, '\\0', 1)")))
    m = m.withColumn("_at", F.expr("7 + octet_length(namespace)"))
    named = F.expr("substring_index(cast(substring(payload, _at) as string), '\\0', 1)")
    m = m.withColumn("relation", F.when(announced, named))
    m = m.withColumn("_at", F.expr("_at + 1 + octet_length(relation)"))
    n = "cast(conv(hex(substring(payload, _at + 1, 2)), 16, 10) as int)"
    fold = F.expr(_LAYOUT.format(p="payload", start="(_at + 1)", n=n))
    begin = F.col("kind") == BEGIN
    return m.select(
        "slot",
        "seq",
        "lsn",
        "kind",
        F.when(~begin, _uint("2", 4)).alias("relation_id"),
        F.when(begin, from_epoch_2000(_int64("10"))).alias("_begin_ts"),
        "namespace",
        "relation",
        F.when(announced, F.expr("cast(substring(payload, _at, 1) as string)")).alias("identity"),
        F.when(announced & F.expr(f"{n} > 0"), fold["cols"]).alias("layout"),
        "payload",
    )


def relations(found: DataFrame) -> DataFrame:
    """Table layouts as announced, from messages or a ``scan`` of them: ``slot, seq,
    relation_id, namespace, relation, identity, layout`` with one array entry per column."""
    read = heads(found) if "payload" in found.columns else found
    return read.filter(F.col("kind") == RELATION).select(
        "slot", "seq", "relation_id", "namespace", "relation", "identity", "layout"
    )


HEAD = (
    "slot string, seq long, lsn long, kind string, relation_id long, _begin_ts timestamp_ntz, "
    "namespace string, relation string, identity string, "
    "layout array<struct<name: string, oid: bigint, typmod: bigint, is_key: boolean>>"
)
CELLS = "array<struct<kind: string, val: string>>"
SCANNED = f"{HEAD}, old_cells {CELLS}, cells {CELLS}"


def scan(messages: DataFrame) -> DataFrame:
    """``heads`` with ``old_cells`` and ``cells``, landed on the shared folder. Tuples are
    split a batch at a time, one array operation per cell position, not row by row. This is
    the only pass over the payloads; a faulty message fails it."""
    path = run_dir(messages.sparkSession, "scanned")
    parsed = heads(messages).mapInArrow(split_batches, SCANNED)
    parsed.write.parquet(path)
    return messages.sparkSession.read.schema(SCANNED).parquet(path)


#: Payload bytes split at a time: text offsets are 32-bit numbers.
SPLIT_BYTES = 256 << 20


def split_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column("payload")), 0).to_numpy(zero_copy_only=False)
        part = sizes.cumsum() // SPLIT_BYTES
        cuts = [0, *((part[1:] != part[:-1]).nonzero()[0] + 1).tolist(), len(part)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            batch = whole.slice(a, b - a)
            old, new = split_payloads(batch.column("payload"))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "payload"]
            names = [n for n in batch.schema.names if n != "payload"]
            yield pa.RecordBatch.from_arrays([*kept, old, new], [*names, "old_cells", "cells"])


def split_payloads(payloads: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Old and new cells of a column of messages (NULL where there are none)."""
    wide = payloads.cast(pa.large_binary())
    _, offsets, body = wide.buffers()
    if len(wide) == 0 or body is None:
        empty = pa.nulls(len(wide), CELL_LIST)
        return empty, empty
    data = np.frombuffer(body, np.uint8)
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    starts, stops = bounds[:-1], bounds[1:]
    if (stops == starts).any():
        raise ValueError("empty replication message")
    kind = data[starts]
    changes = np.isin(kind, [ord(k) for k in CHANGES]).nonzero()[0]
    stops = stops[changes]
    if (starts[changes] + 6 > stops).any():
        raise ValueError("replication message cut off before its tuple")
    tag = data[starts[changes] + 5]
    old_first = np.isin(tag, [ord(t) for t in OLD_TAGS])
    new_first = tag == ord(NEW_TAG)
    # INSERT: a new tuple; DELETE: an old one; UPDATE: a new one, or an old and a new one.
    fits = np.where(
        kind[changes] == ord(INSERT), new_first,
        np.where(kind[changes] == ord(DELETE), old_first, old_first | new_first),
    )
    if not fits.all():
        raise ValueError(f"replication message with tuple tag {chr(tag[~fits][0])!r}")
    first = _Tuples(data, starts[changes] + 6, stops)
    # An UPDATE with an old tuple is followed by one more tag byte and the new tuple.
    both = old_first & (kind[changes] == ord(UPDATE))
    if (first.end[both] >= stops[both]).any() or (data[first.end[both]] != ord(NEW_TAG)).any():
        raise ValueError("UPDATE message without a new tuple after the old one")
    second = _Tuples(data, first.end[both] + 1, stops[both])
    if (first.end[~both] != stops[~both]).any() or (second.end != stops[both]).any():
        raise ValueError("replication message longer than its tuples")
    old = first.lists(len(wide), changes, old_first)
    plain = first.lists(len(wide), changes, ~both)
    after = second.lists(len(wide), changes[both], np.ones(both.sum(), bool))
    has_after = np.zeros(len(wide), bool)
    has_after[changes[both]] = True
    return old, pc.if_else(pa.array(has_after), after, plain)


CELL = pa.struct([("kind", pa.string()), ("val", pa.string())])
CELL_LIST = pa.list_(CELL)


class _Tuples:
    """Cells of the tuples that start at the given byte positions.

    A tuple is a 16-bit cell count, then per cell a kind byte and, for text, a 32-bit length
    and the bytes; numbers are big-endian."""

    def __init__(self, data: np.ndarray, at: np.ndarray, stops: np.ndarray):
        """``stops``: where each tuple's message ends; nothing is read beyond it."""
        self.data = data
        if (at + 2 > stops).any():
            raise ValueError("replication message cut off before its cell count")
        self.count = data[at].astype(np.int64) << 8 | data[at + 1]
        shape = (len(at), int(self.count.max(initial=0)))
        self.kind = np.zeros(shape, np.uint8)
        self.start = np.zeros(shape, np.int64)
        self.size = np.zeros(shape, np.int64)
        pos = at + 2
        for j in range(shape[1]):
            live = (self.count > j).nonzero()[0]
            if (pos[live] >= stops[live]).any():
                raise ValueError("replication message cut off before a cell")
            kind = data[pos[live]]
            if not np.isin(kind, [ord(c) for c in CELL_KINDS]).all():
                raise ValueError("replication message with an unknown kind of cell")
            text = live[kind == ord(TEXT_CELL)]
            p = pos[text]
            if (p + 5 > stops[text]).any():
                raise ValueError("replication message cut off in a cell's length")
            size = sum(data[p + 1 + b].astype(np.int64) << (24 - 8 * b) for b in range(4))
            self.kind[live, j] = kind
            self.start[text, j] = p + 5
            self.size[text, j] = size
            pos[live] += 1
            pos[text] += 4 + size
            if (pos[text] > stops[text]).any():
                raise ValueError("replication message cut off in a cell")
        self.end = pos

    def lists(self, n: int, rows: np.ndarray, chosen: np.ndarray) -> pa.Array:
        """A list column of length ``n``: the chosen tuples at their rows, NULL elsewhere."""
        count = np.zeros(n, np.int64)
        count[rows[chosen]] = self.count[chosen]
        present = np.zeros(n, bool)
        present[rows[chosen]] = True
        used = np.arange(self.kind.shape[1]) < self.count[chosen, None]
        kind = self.kind[chosen][used]
        start, size = self.start[chosen][used], self.size[chosen][used]
        cells = pa.StructArray.from_arrays(
            [self._kinds(kind), self._texts(kind, start, size)], fields=list(CELL)
        )
        offsets = np.concatenate([[0], count.cumsum()]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), cells, type=CELL_LIST, mask=pa.array(~present)
        )

    @staticmethod
    def _kinds(kind: np.ndarray) -> pa.Array:
        ends = np.arange(len(kind) + 1, dtype=np.int32)
        return pa.StringArray.from_buffers(len(kind), pa.py_buffer(ends), pa.py_buffer(kind.tobytes()))

    def _texts(self, kind: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], size.cumsum()])
        source = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
        valid = np.packbits(kind == ord(TEXT_CELL), bitorder="little")
        return pa.StringArray.from_buffers(
            len(kind),
            pa.py_buffer(ends.astype(np.int32)),
            pa.py_buffer(self.data[source].tobytes()),
            pa.py_buffer(valid.tobytes()),
        )


def decode(found: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Change rows ``slot, seq, lsn, op, relation_id, relation, relation_seq, commit_ts,
    deleted_ts, columns, cells, old_cells`` of messages, or of a ``scan`` of them.

    The commit time comes from the last transaction start of the slot, names and table from
    the last layout of the relation. Messages are cut by ``seq`` into chunks; each chunk
    starts with rows that repeat what was in force before it. Both windows share one
    shuffle. Given messages, their scan runs at once."""
    scanned = scan(found) if "payload" in found.columns else found
    layout = F.struct(
        F.col("seq").alias("relation_seq"),
        "relation",
        F.expr("transform(layout, c -> c.name)").alias("columns"),
    )
    parsed = dense_chunks(scanned, "seq", rows_per_chunk).select(
        "slot", "seq", "lsn", "kind", "relation_id", "_begin_ts", CHUNK, "old_cells", "cells",
        F.when(F.col("kind") == RELATION, layout).alias("_layout"),
    )
    # Per chunk: the relations that occur and the last transaction start (heads only).
    spine = parsed.groupBy("slot", "relation_id", CHUNK).agg(
        F.max_by("_begin_ts", F.when(F.col("_begin_ts").isNotNull(), F.col("seq"))).alias(
            "_begin_ts"
        )
    )
    by_slot = Window.partitionBy("slot").orderBy(CHUNK)
    starts = (
        spine.groupBy("slot", CHUNK)
        .agg(F.max("_begin_ts").alias("_begin_ts"))
        .withColumn(
            "_begin_ts",
            F.last("_begin_ts", ignorenulls=True).over(
                by_slot.rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
    )
    last_layout = (
        parsed.filter(F.col("kind") == RELATION)
        .groupBy("slot", "relation_id", CHUNK)
        .agg(F.max_by("_layout", "seq").alias("_layout"))
    )
    occurring = spine.filter(F.col("relation_id").isNotNull()).select(
        "slot", "relation_id", CHUNK, F.lit(True).alias("_occurs")
    )
    by_relation = Window.partitionBy("slot", "relation_id").orderBy(CHUNK)
    handed = (
        occurring.unionByName(last_layout, allowMissingColumns=True)
        .withColumn(
            "_layout",
            F.last("_layout", ignorenulls=True).over(
                by_relation.rangeBetween(Window.unboundedPreceding, -1)
            ),
        )
        .filter("_occurs")
        .drop("_occurs")
    )
    edge = "_edge"
    rows = (
        parsed.withColumn(edge, F.lit(0))
        .unionByName(starts.withColumn(edge, F.lit(-1)), allowMissingColumns=True)
        .unionByName(handed.withColumn(edge, F.lit(-1)), allowMissingColumns=True)
    )
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    in_slot = Window.partitionBy("slot", CHUNK).orderBy(edge, "seq").rowsBetween(*upto_here)
    in_relation = (
        Window.partitionBy("slot", CHUNK, "relation_id")
        .orderBy(edge, "seq")
        .rowsBetween(*upto_here)
    )
    known = rows.withColumn(
        "commit_ts", F.last("_begin_ts", ignorenulls=True).over(in_slot)
    ).withColumn("_layout", F.last("_layout", ignorenulls=True).over(in_relation))
    deleted = F.when(F.col("kind") == DELETE, F.col("commit_ts"))
    return known.filter(F.col("kind").isin(*CHANGES)).select(
        "slot",
        "seq",
        "lsn",
        F.col("kind").alias("op"),
        "relation_id",
        "_layout.relation",
        "_layout.relation_seq",
        "commit_ts",
        deleted.alias("deleted_ts"),
        "_layout.columns",
        "cells",
        "old_cells",
    )


def named_cells(changes: DataFrame) -> DataFrame:
    """Pair each cell with its column name: adds the map ``row``."""
    return changes.withColumn("row", F.map_from_arrays("columns", "cells"))


def typed_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract columns of one table. A value that was not sent, or text that is no value
    of the column's type, fails the job; a NULL of a delete stays NULL. ``text_rows`` keeps
    the text for ``validate``, which moves such rows to the quarantine instead."""
    out = changes.filter(F.col("relation") == spec.name)
    cells = {}
    for f in spec.schema.fields:
        cell = F.get("cells", F.array_position("columns", F.lit(f.name)).cast("int") - 1)
        unsent = F.raise_error(F.lit(f"unchanged value not sent for column {f.name}"))
        text = F.when(cell["kind"] == UNSENT_CELL, unsent.cast("string")).otherwise(cell["val"])
        typed = try_typed(text, f.dataType)
        wrong = F.raise_error(F.concat(F.lit(f"column {f.name}: no {f.dataType.simpleString()}: "), text))
        cells[f.name] = F.when(failed_cast(text, typed), wrong.cast(f.dataType)).otherwise(typed)
    keep = ["slot", "seq", "op", "lsn", "commit_ts", "deleted_ts"]
    return out.select(*keep, *[c.alias(n) for n, c in cells.items()])


def text_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract columns of one table as the text that was sent, for ``validate.prepare``."""
    out = changes.filter(F.col("relation") == spec.name)
    cells = {}
    for f in spec.schema.fields:
        cell = F.get("cells", F.array_position("columns", F.lit(f.name)).cast("int") - 1)
        unsent = F.raise_error(F.lit(f"unchanged value not sent for column {f.name}"))
        cells[f.name] = F.when(cell["kind"] == UNSENT_CELL, unsent.cast("string")).otherwise(cell["val"])
    keep = ["seq", "op", "lsn", "commit_ts", "deleted_ts"]
    return out.select(*keep, *[c.alias(n) for n, c in cells.items()])


def ignored_truncates(messages: DataFrame) -> DataFrame:
    """Truncate messages change nothing; they are counted for the drop report."""
    return (
        with_kind(messages)
        .filter(F.col("kind") == TRUNCATE)
        .groupBy(F.col("slot").alias("table_name"), F.lit("truncate_ignored").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def relation_versions(changes: DataFrame, layouts: DataFrame) -> DataFrame:
    """Each announced table version with its columns and the changes written under it."""
    counted = changes.groupBy("slot", "relation_seq").agg(F.count(F.lit(1)).alias("n_changes"))
    named = layouts.select(
        "slot",
        F.col("seq").alias("relation_seq"),
        "relation",
        F.expr("transform(layout, c -> c.name)").alias("columns"),
    )
    return named.join(counted, ["slot", "relation_seq"], "left").withColumn(
        "n_changes", F.coalesce("n_changes", F.lit(0))
    )
