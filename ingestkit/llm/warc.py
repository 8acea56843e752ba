"""WARC archives as a chunked record table.

Writing: a payload becomes rows (record, chunk number, bytes) of at most ``CHUNK_BYTES``; the rows of a
record follow each other in one task, which streams them into a gzip member of its archive and carries
the digest along. Reading yields the same kind of rows, each with the SHA-256 of the payload so far, so
neither side ever holds a whole oversized record. Of equal payloads of ``REVISIT_BYTES`` or more, the
record with the smallest id is a response and the others are revisits that refer to it and hold no
payload.

Every task writes files of its own name and returns their paths as rows; the manifest of paths is a
written table, so files of lost or repeated attempts are never read. Archives go to the shared work
folder through a file system that its URI names.

Defined results: a null payload is empty; null ids are written as ``null`` and are larger than any
other; rows that share id and payload with the response are responses too; null URLs are empty, and
control characters and spaces in URLs are percent-encoded. An empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy, written
from ingestkit.session import scratch_path

CHUNK_BYTES = 1 << 20
REVISIT_BYTES = 100
FILE_BYTES = 1 << 28
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "<urn:page:%s>"


def record_rows(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "page_id", url_col: str = "url",
                body_col: str = "html") -> DataFrame:
    """Chunk rows of all pages with what the record's header needs; the chunks of a record are adjacent."""
    body = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    ).select("*", F.sha2("body", 256).alias("digest"), F.octet_length("body").cast("long").alias("size"))
    equal = body.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
    equal = written(equal.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "equal")
    known = body.join(equal, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    last = F.when(revisit, F.lit(0)).otherwise(F.greatest(F.ceil(F.col("size") / chunk_bytes) - 1, F.lit(0))).cast("int")
    return known.select(
        "page_id", "url", "digest", "size", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"),
        "body", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"),
    ).select(
        "page_id", "url", "digest", "size", "refers_to", "revisit", "chunk_no",
        F.when(~F.col("revisit"), F.substr("body", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).alias("data"),
    )


def _head(r: dict) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode()
    name = "null" if r["page_id"] is None else r["page_id"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if r['revisit'] else 'response'}",
        f"WARC-Record-ID: {ID % name}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(r['url'], safe='!#$%&()*+,/:;=?@[]~' + chr(39))}",
        f"WARC-Payload-Digest: sha256:{r['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if r['revisit'] else r['size'])}",
    ]
    if r["revisit"]:
        lines += [f"WARC-Refers-To: {ID % r['refers_to']}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archive:
    """Gzip members written one after another to files of bounded size."""

    def __init__(self, folder: str):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.folder, self.file, self.done = folder, None, []

    def begin(self) -> None:
        if self.file is None:
            self.fs.create_dir(self.path, recursive=True)
            self.name, self.bytes, self.records = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
            self.file = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        self.pack = zlib.compressobj(6, zlib.DEFLATED, 31)

    def add(self, data: bytes, end: bool = False) -> None:
        out = self.pack.compress(data) + (self.pack.flush() if end else b"")
        self.file.write(out)
        self.bytes += len(out)
        if end:
            self.records += 1
            if self.bytes >= FILE_BYTES:
                self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append({"path": f"{self.folder}/{self.name}", "records": self.records, "bytes": self.bytes})
            self.file = None


def write_archives(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the records of ``record_rows`` and returns the manifest (path, records, bytes)."""
    folder = folder or scratch_path(rows.sparkSession, "llm-warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Archive(folder), None
        for b in batches:
            for i in range(b.num_rows):
                r = {k: b.column(k)[i].as_py() for k in b.schema.names}
                if r["chunk_no"] == 0:
                    out.begin()
                    out.add(_head(r))
                    digest, left = hashlib.sha256(), 0 if r["revisit"] else r["size"]
                data = r["data"] or b""
                digest.update(data)
                left -= len(data)
                if left == 0 and not r["revisit"] and digest.hexdigest() != r["digest"]:
                    raise ValueError(f"payload of page {r['page_id']} does not match its digest")
                out.add(data + (b"" if left else b"\r\n\r\n"), end=left == 0)
        out.close()
        schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist(out.done, schema)

    return written(rows.mapInArrow(tidy(run), "path string, records long, bytes long"), "manifest")


def _header(stream) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        k, _, v = line.decode().partition(": ")
        out[k.lower()] = v
    return out


def records(stream, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of one decompressed archive; the last chunk of a record has ``last`` set."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:20]!r}")
        h = _header(stream)
        stream.readline()  # the HTTP status
        size = int(_header(stream)["content-length"])
        row = {
            "record_id": h["warc-record-id"],
            "record_type": h["warc-type"],
            "url": h["warc-target-uri"],
            "refers_to": h.get("warc-refers-to"),
            "payload_bytes": size,
        }
        if h["warc-type"] == "revisit":
            digest = h["warc-payload-digest"].removeprefix("sha256:")
            yield row | {"chunk_no": 0, "data": b"", "digest": digest, "last": True}
        else:
            state, at, no = hashlib.sha256(), 0, 0
            while True:
                data = stream.read(min(chunk_bytes, size - at))
                if len(data) < min(chunk_bytes, size - at):
                    raise ValueError(f"{row['record_id']} ends early")
                at += len(data)
                state.update(data)
                yield row | {"chunk_no": no, "data": data, "digest": state.hexdigest(), "last": at == size}
                no += 1
                if at == size:
                    break
            if "sha256:" + state.hexdigest() != h["warc-payload-digest"]:
                raise ValueError(f"{row['record_id']} does not match its digest")
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{row['record_id']} has no end")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives: record_id, record_type, url, refers_to, payload_bytes,
    chunk_no, data, digest (SHA-256 of the payload up to this chunk), last. One task per archive."""
    n = max(manifest.count(), 1)
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()), ("chunk_no", pa.int32()), ("data", pa.binary()), ("digest", pa.string()),
        ("last", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(name, compression=None) as f, gzip.GzipFile(fileobj=f) as stream:
                    for r in records(stream, chunk_bytes):
                        rows.append(r)
                        size += len(r["data"])
                        if len(rows) >= 1000 or size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    out = ("record_id string, record_type string, url string, refers_to string, payload_bytes long, chunk_no int, "
           "data binary, digest string, last boolean")  # fmt: skip
    return manifest.select("path").repartition(n).mapInArrow(tidy(run), out)


def page_of(record_id: str) -> F.Column:
    """The page id of a record id; null for the id of a page without one."""
    return F.regexp_extract(record_id, re.escape(ID).replace("%s", "(.*)"), 1).try_cast("long")


def pages_back(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return chunks.where("last").select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND low < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND low < page_id THEN low END AS refers_to
FROM m"""
