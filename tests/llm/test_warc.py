import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard

from tests.llm.conftest import as_rows, clashing, words
from tidelog.llm import warc

PAGES = "page_id long, url string, html string"
COLUMNS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, url, h in rows:
        data = (h or "").encode()
        owner = first.get(h or "")
        revisit = i != owner
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, url, len(data), digest, "revisit" if revisit else "response", owner if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (3, "http://a/\r\nx%", "<p>é漢</p>"), (1, None, "<p>é漢</p>"), (2, "u", None), (9, "u", ""), (4, "u", "\r\n\r\nWARC/1.1\r\n"),
    (5, "v", "x" * 3_000_000), (5, "v", "x" * 3_000_000), (None, "n", "only"), (None, "n", "<p>é漢</p>"),
]


def test_round_trip(spark):
    df = clashing(spark.createDataFrame(ROWS, PAGES).repartition(3))
    assert as_rows(warc.round_trip(df), *COLUMNS) == expected(ROWS)


def test_many_records_use_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"<html><body><p>number {i} {words(rng, 60)}</p></body></html>") for i in range(900)]
    folder = str(tmp_path / "w")
    files = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    assert as_rows(warc.read_archives(files, folder), *COLUMNS) == expected(rows)
    with open(files.first()["file"], "rb") as f:
        assert struct.unpack("<I", f.read(4))[0] == warc.DICT_MAGIC


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_least_size(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    folder = str(tmp_path / "w")
    out = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, PAGES), folder, least=3), folder)
    assert as_rows(out, "page_id", "record_type") == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def archive(*records, trained=None):
    coder = zstandard.ZstdCompressor(dict_data=trained) if trained else zstandard.ZstdCompressor()
    head = warc.skippable(trained.as_bytes()) if trained else b""
    return head + b"".join(coder.compress(r) for r in records)


def test_frames_across_reads_and_compressed_dictionary():
    records = [warc.record(i, "u", b"payload %d" % i * 50, False, None, "d") for i in range(400)]
    trained = warc.train(records)
    plain = archive(*records, trained=trained)
    packed = warc.skippable(zstandard.ZstdCompressor().compress(trained.as_bytes())) + plain[8 + len(trained.as_bytes()) :]
    for data in (plain, packed, archive(*records)):
        for chunk in (1, 7, 1 << 20):
            assert list(warc.frames(io.BytesIO(data), chunk)) == records


@pytest.mark.parametrize("cut", [1, 5, 200])
def test_cut_off_archive_raises(cut):
    data = archive(*[warc.record(i, "u", b"x" * 500, False, None, "d") for i in range(3)])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(io.BytesIO(data[: len(data) - cut])))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WORC/1.1"),
        (b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"),
        (b"WARC-Date: d", b"WARC-Date d"),
        (b"WARC-Record-ID", b"WARC-Date"),
        (b"payload", b"pAyload"),
        (b"Content-Type: application/http", b"Content-Length: 3\r\nX: a"),
    ],
)
def test_bad_records_raise(old, new):
    data = warc.record(1, "u", b"payload", False, None, "d")
    assert warc.parse(data)["payload"] == b"payload" and old in data
    with pytest.raises(ValueError):
        warc.parse(data.replace(old, new))
