"""WARC archives compressed with Zstandard: one frame per record, a dictionary per file.

A file begins with a skippable frame that holds the dictionary; each record then is one
frame of its own, so a reader can start at any of them. Archives are written and read by
tasks, one stream each, with one record in memory at a time.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed, text_of
from tidelog.session import run_dir

#: Magic number of the skippable frame for dictionaries (.warc.zst).
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A file's dictionary is trained on its first records, up to these bounds.
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 256, 4 << 20, 16 << 10
#: A file is closed when its compressed size passes this.
FILE_BYTES = 64 << 20
LEVEL = 6

MANIFEST = "file string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> bytes:
    """A header value on one line."""
    return value.encode().replace(b"%", b"%25").replace(b"\r", b"%0D").replace(b"\n", b"%0A")


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"none" if page_id is None else str(page_id).encode())


def record(page_id, url, payload: bytes, revisit: bool, refers_to, date: str) -> bytes:
    """One WARC record. The block of a revisit is the HTTP head alone; its Content-Length
    and digest are those of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + _urn(page_id),
        b"WARC-Date: " + date.encode(),
        b"Content-Type: application/http;msgtype=response",
        b"WARC-Payload-Digest: sha1:" + digest32(payload).encode(),
    ]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _line(url))
    if revisit:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: " + _urn(refers_to)]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records of a file; none where they are too few for it."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples)
    except zstandard.ZstdError:
        return None


def skippable(content: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(content)) + content


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        # Another attempt of the task writes other names; only a finished one is listed.
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, size, out, coder, listed = [], 0, None, None, []

        def open_file():
            nonlocal out, coder
            path = f"{root}/{stem}-{len(listed):04d}.warc.zst"
            listed.append([path, 0, 0])
            out = store.open_output_stream(path, compression=None)
            trained = train(held)
            coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
            if trained:
                put(skippable(trained.as_bytes()))
            for r in held:
                put(coder.compress(r), 1)
            held.clear()

        def put(data: bytes, records: int = 0):
            out.write(data)
            listed[-1][1] += records
            listed[-1][2] += len(data)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("page_id", "url", "payload", "first_id")}
                revisit = row["page_id"] != row["first_id"]
                r = record(row["page_id"], row["url"], row["payload"].encode(), revisit, row["first_id"], date)
                if out is None:
                    held.append(r)
                    size += len(r)
                    if len(held) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                        open_file()
                        size = 0
                    continue
                put(coder.compress(r), 1)
                if listed[-1][2] >= FILE_BYTES:
                    out.close()
                    out = None
        if held:
            open_file()
        if out is not None:
            out.close()
        names, records, sizes = zip(*listed, strict=True) if listed else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            ["file", "n_records", "n_bytes"],
        )

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages``; the manifest (file, n_records, n_bytes).

    Of rows with equal payloads of at least ``least`` bytes, those with the smallest page_id
    are responses, the others revisit it; smaller payloads are all responses. Null html is
    empty. Rows that repeat a page_id and payload are written as often as they come. A null
    page_id is never the smallest, unless all are null: then they are responses. An empty
    table writes no file. Equal payloads are counted before any text moves: the smallest
    page_id per digest comes from one partial aggregate.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       text_of("html").alias("payload"))
    digest = F.unhex(F.sha1("payload"))
    first = own.select("page_id", digest.alias("digest")).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    joined = own.withColumn("digest", digest).join(first, "digest")
    small = F.octet_length("payload") < least
    joined = joined.select(
        "page_id", "url", "payload", F.when(small, F.col("page_id")).otherwise(F.col("first_id")).alias("first_id")
    )
    return landed(joined.mapInArrow(_write(folder, date), MANIFEST), "manifest")


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The content of each frame, decoded with the dictionary of the leading skippable
    frame if there is one. Raises where a frame is cut off or damaged."""
    held = stream.read(8)
    trained = None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICT_MAGIC:
        size = struct.unpack("<I", held[4:])[0]
        content = stream.read(size)
        if len(content) < size:
            raise ValueError("cut off in the dictionary")
        if content[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
            content = zstandard.ZstdDecompressor().decompress(content)
        trained, held = zstandard.ZstdCompressionDict(content), b""
    decoder = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    while held or (held := stream.read(chunk)):
        one, out = decoder.decompressobj(read_across_frames=False), io.BytesIO()
        while True:
            out.write(one.decompress(held))
            if one.eof:
                held = one.unused_data
                break
            if not (held := stream.read(chunk)):
                raise ValueError("cut off in a frame")
        yield out.getvalue()


def parse(data: bytes) -> dict:
    """Head and payload of one record; raises where the head or a length is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        raise ValueError(f"no WARC record: {data[:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.lower() in fields:
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length"):
        if name not in fields:
            raise ValueError(f"no {name.decode()}")
    n = int(fields[b"content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n}, block of {len(rest) - 4}")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or b"warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload or without a reference")
    return fields | {"payload": payload, "length": length, "digest": digest, "kind": kind}


def _page(urn: bytes | None) -> int | None:
    name = (urn or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(name) if name not in (b"", b"none") else None


def _read(folder: str):
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, expected in zip(batch.column("file").to_pylist(), batch.column("n_records").to_pylist(), strict=True):
                rows, n = [], 0
                with store.open_input_stream(file, compression=None) as stream:
                    for data in frames(stream):
                        r = parse(data)
                        url = r.get(b"warc-target-uri")
                        url = None if url is None else url.replace(b"%0A", b"\n").replace(b"%0D", b"\r").replace(b"%25", b"%").decode()
                        rows.append((_page(r[b"warc-record-id"]), url, r["length"], r["digest"], r["kind"],
                                     _page(r.get(b"warc-refers-to"))))
                        n += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)
                            rows = []
                if n != expected:
                    raise ValueError(f"{file} has {n} records, the manifest {expected}")
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)

    return run


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the listed files, each checked; a file is one task's stream."""
    return manifest.repartition(_parts(manifest)).mapInArrow(_read(folder), RECORDS)


def _parts(manifest: DataFrame) -> int:
    return max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to the shared folder and read the archives back."""
    folder = run_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
