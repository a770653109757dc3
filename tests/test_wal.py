"""Replication messages built by hand."""

import re
import struct

import pytest
from pyspark.sql import types as T
from tests.conftest import rows

from tidelog.functions.cells import spark_type, try_typed
from tidelog.sources import wal
from tidelog.spec import PROVIDERS
from pyspark.sql import functions as F

REL = 77
MICROS = 86_400_000_000  # one day after 2000-01-01


def cells(*values):
    out = struct.pack(">h", len(values))
    for v in values:
        if v is None:
            out += b"n"
        elif v is ...:
            out += b"u"
        else:
            data = v.encode()
            out += b"t" + struct.pack(">i", len(data)) + data
    return out


def relation(*columns, name="providers"):
    out = b"R" + struct.pack(">i", REL) + b"public\0" + name.encode() + b"\0" + b"f"
    out += struct.pack(">h", len(columns))
    for col, oid, typmod in columns:
        out += b"\1" + col.encode() + b"\0" + struct.pack(">ii", oid, typmod)
    return out


def change(kind, *parts):
    return kind + struct.pack(">i", REL) + b"".join(parts)


BEGIN = b"B" + struct.pack(">qqi", 500, MICROS, 9)
COMMIT = b"C" + struct.pack(">bqqq", 0, 500, 501, MICROS)
LAYOUT = relation(("provider_id", 25, -1), ("name", 1043, 24), ("specialty", 25, -1))


def messages(spark, *payloads):
    data = [("s", i, 100 + i, bytearray(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "slot string, seq long, lsn long, payload binary")


@pytest.mark.parametrize("size", [2, 1000])
def test_all_kinds(spark, size):
    m = messages(
        spark,
        BEGIN,
        LAYOUT,
        change(b"I", b"N", cells("p1", "Zoë", None)),
        change(b"U", b"N", cells("p1", "Zoe", "GP")),
        change(b"U", b"K", cells("p1", None, None), b"N", cells("p2", "Zoe", "GP")),
        change(b"U", b"O", cells("p2", "Zoe", "GP"), b"N", cells("p2", "", "GP")),
        change(b"D", b"O", cells("p2", "", "GP")),
        b"T" + struct.pack(">ibi", 1, 0, REL),
        COMMIT,
    )
    changes = wal.decode(m, rows_per_chunk=size)
    out = wal.typed_rows(changes, PROVIDERS)
    assert rows(out, "seq", "op", "lsn", "provider_id", "name", "specialty") == [
        (2, "I", 102, "p1", "Zoë", None),
        (3, "U", 103, "p1", "Zoe", "GP"),
        (4, "U", 104, "p2", "Zoe", "GP"),
        (5, "U", 105, "p2", "", "GP"),
        (6, "D", 106, "p2", "", "GP"),
    ]
    assert {str(r["commit_ts"]) for r in out.collect()} == {"2000-01-02 00:00:00"}
    assert rows(out.filter("deleted_ts is not null"), "op") == [("D",)]
    old = changes.filter("old_cells is not null").selectExpr("seq", "old_cells[0].val")
    assert rows(old) == [(4, "p1"), (5, "p2"), (6, "p2")]
    assert rows(wal.ignored_truncates(m), "reason", "n_rows") == [("truncate_ignored", 1)]


def test_layout_of_a_relation(spark):
    r = wal.relations(messages(spark, LAYOUT)).first()
    assert (r["relation_id"], r["namespace"], r["relation"], r["identity"]) == (
        REL,
        "public",
        "providers",
        "f",
    )
    assert [tuple(c) for c in r["layout"]] == [
        ("provider_id", 25, -1, True),
        ("name", 1043, 24, True),
        ("specialty", 25, -1, True),
    ]


def test_payloads_are_read_once(spark, tmp_path, monkeypatch):
    """The scan reads the messages; changes and layouts come from what it landed, the
    summaries of chunks from the heads alone."""
    path = str(tmp_path / "landed")
    messages(spark, BEGIN, LAYOUT, change(b"I", b"N", cells("p1", "a", "b"))).write.parquet(path)
    reads = []
    heads = wal.heads
    monkeypatch.setattr(wal, "heads", lambda m: reads.append(1) or heads(m))
    scanned = wal.scan(spark.read.parquet(path))
    versions = wal.relation_versions(wal.decode(scanned), wal.relations(scanned))
    assert rows(versions, "relation_seq", "n_changes") == [(1, 1)] and len(reads) == 1
    text = wal.decode(scanned)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert len(read) > 1 and "payload#" not in text
    assert sum("cells#" in columns for columns in read) == 1


def test_key_only_delete_gives_null_not_dummies(spark):
    m = messages(spark, BEGIN, LAYOUT, change(b"D", b"K", cells("p1", None, None)))
    out = wal.typed_rows(wal.decode(m), PROVIDERS)
    assert rows(out, "provider_id", "name", "specialty") == [("p1", None, None)]


def test_new_layout_applies_from_its_position_on(spark):
    wide = relation(("provider_id", 25, -1), ("name", 25, -1), ("specialty", 25, -1), ("extra", 25, -1))
    m = messages(
        spark,
        BEGIN,
        LAYOUT,
        change(b"I", b"N", cells("p1", "a", "b")),
        wide,
        change(b"I", b"N", cells("p2", "a", "b", "c")),
    )
    named = wal.named_cells(wal.decode(m, rows_per_chunk=2))
    sizes = named.selectExpr("seq", "map_keys(row) as names")
    assert [len(r["names"]) for r in sizes.orderBy("seq").collect()] == [3, 4]
    versions = wal.relation_versions(wal.decode(m), wal.relations(m))
    assert rows(versions, "relation_seq", "n_changes") == [(1, 1), (3, 1)]


@pytest.mark.parametrize(
    "payload, error",
    [
        (b"X123", "unknown replication message 58"),
        (change(b"D", b"N", cells("p1", None, None)), "without an old tuple"),
        (change(b"U", b"N", cells("p1", ..., "GP")), "unchanged value not sent for column name"),
    ],
)
def test_bad_messages_fail(spark, payload, error):
    m = messages(spark, BEGIN, LAYOUT, payload)
    with pytest.raises(Exception, match=error):
        wal.typed_rows(wal.decode(m), PROVIDERS).collect()


def test_types_by_number():
    assert spark_type(1700, ((12 << 16) | 3) + 4) == T.DecimalType(12, 3)
    assert spark_type(1700) == T.DecimalType(38, 18)
    assert spark_type(1184) == T.TimestampType()
    assert spark_type(1114) == T.TimestampNTZType()
    assert spark_type(21) == T.ShortType()
    assert spark_type(424242) == T.StringType()


@pytest.mark.parametrize(
    "text, oid, want",
    [
        ("t", 16, "true"),
        ("off", 16, "false"),
        ("maybe", 16, None),
        ("42", 20, "42"),
        ("0/103D8F0", 20, None),
        ("2024-01-02", 1082, "2024-01-02"),
        ("12:30:00", 1083, "12:30:00"),
        ("not-a-datetime", 1184, None),
        ("1.5", 701, "1.5"),
        ('{"a": 1}', 3802, '{"a":1}'),
        ("{broken", 114, None),
        ("\\x4142", 17, "AB"),
        ("4142", 17, None),
    ],
)
def test_cell_text_to_value(spark, text, oid, want):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(try_typed(F.col("c"), spark_type(oid)).cast("string")).first()[0] == want


def test_well_formed_tuples_are_split():
    import pyarrow as pa

    messages = [
        change(b"I", b"N", cells("a", None)),
        change(b"U", b"K", cells("old", None), b"N", cells("new", ...)),
        change(b"D", b"O", cells("gone", "x")),
        b"B" + b"\0" * 20,
    ]
    old, new = wal.split_payloads(pa.array(messages, pa.binary()))
    assert [[c["val"] for c in x] if x else None for x in old.to_pylist()] == [None, ["old", None], ["gone", "x"], None]
    # A delete's only tuple is its old one.
    assert [c["val"] for c in new.to_pylist()[1]] == ["new", None]


@pytest.mark.parametrize(
    "message",
    [
        change(b"I", b"N", struct.pack(">h", 2), b"b", b"n"),  # unknown kind of cell
        change(b"U", b"K", cells("a"), b"X", cells("b")),  # second tag
        change(b"U", b"K", cells("a")),  # no second tuple
        change(b"I", b"Q", cells("a")),  # first tag
        change(b"D", b"N", cells("a")),
        change(b"I", b"N", struct.pack(">h", 3), b"n"),  # fewer cells than counted
        change(b"I", b"N", struct.pack(">h", 1), b"t", struct.pack(">i", 9), b"abc"),  # cut off text
        change(b"I", b"N", struct.pack(">h", 1), b"t\0\0"),
        change(b"I", b"N", b"\0"),
        change(b"I", b"N", cells("a"), b"more"),
        b"",
    ],
)
def test_malformed_tuples_raise(message):
    """Nothing is read from the bytes of the message that follows."""
    import pyarrow as pa

    good = change(b"I", b"N", cells("next", "message", "bytes"))
    with pytest.raises(ValueError):
        wal.split_payloads(pa.array([good, message, good], pa.binary()))


def test_batches_are_cut_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(wal, "SPLIT_BYTES", 60)
    payloads = [change(b"I", b"N", cells(f"value {i}")) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(payloads, pa.binary())], ["seq", "payload"])
    out = list(wal.split_batches(iter([batch])))
    assert len(out) > 5
    assert [c[0]["val"] for b in out for c in b.column("cells").to_pylist()] == [f"value {i}" for i in range(20)]


@pytest.mark.parametrize("text", ["1234567890123456789012.5", "NaN", "0.1234567890123456789", "1e3x"])
def test_numbers_that_do_not_fit_are_faults(spark, text):
    """Neither rounded nor lost: the value is no value of the type, and a row fails for it."""
    from tidelog.functions.cells import failed_cast

    df = spark.createDataFrame([(text,)], "t string")
    typed = try_typed(F.col("t"), spark_type(1700))
    assert df.select(failed_cast(F.col("t"), typed).alias("f")).first()["f"]


def test_wide_numbers_keep_their_text():
    assert spark_type(1700, ((40 << 16) | 2) + 4) == T.StringType()
