"""WARC records as a chunked record table.

An archive is a table ``record, chunk, chunks, data, running``: the data of a record's chunks, one after the other,
are the bytes of one WARC 1.1 record, and records end to end are a WARC file. Records up to ``CHUNK`` bytes are one
row; larger payloads leave as rows of ``CHUNK`` bytes cut from the input buffer, so that no record is ever copied
whole. ``running`` is the SHA-1 of the payload up to the chunk's end. Reading takes one-row records where they lie
and streams the chunks of larger ones, sorted by record and number, through one incremental digest.

Payloads of at least ``least`` bytes that are equal share one response record, that of the smallest page id; the
others become revisit records without payload. Only ids and digests are grouped and joined by digest, and only digests
that repeat; what a page refers to is then joined to it by its id, so copies of one page are spread like all others.

Defined cases: a null payload is an empty one. Rows with a null page id are left out. Every other row gives one
record, so repeated rows give repeated records, of type response if their id is the smallest. A null url is an empty
target. Extra columns are ignored. An empty table gives an empty archive. A damaged archive raises ``ValueError``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep

#: Bytes of a chunk, and bytes that a result batch holds at most.
CHUNK, BATCH_BYTES = 1 << 20, 16 << 20
#: Records carry no clock time: equal input gives equal archives.
DATE = "2000-01-01T00:00:00Z"
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = pa.schema([("record", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("data", pa.binary()), ("running", pa.string())])
_READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _head(page: int, url: str, size: int, digest: str, first: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{page}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if first is not None:
        lines += [f"WARC-Refers-To: <{_ID}{first}>", f"WARC-Profile: {_PROFILE}"]
    lines.append(f"Content-Length: {len(http) + (size if first is None else 0)}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (page_id, url, html, sha, first) to chunk rows."""
    record = TaskContext.get().partitionId() << 33
    held: list[tuple] = []
    size = 0

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNKS, strict=True)], schema=_CHUNKS)

    for batch in batches:
        pages, urls, bodies, shas, firsts = batch.columns
        for page, url, body, sha, first in zip(pages.to_pylist(), urls.to_pylist(), bodies, shas.to_pylist(), firsts.to_pylist(), strict=True):
            payload = memoryview(body.as_buffer()) if body.is_valid else memoryview(b"")
            head = _head(page, url or "", len(payload), _base32(bytes.fromhex(sha)), first)
            stored = payload if first is None else payload[:0]
            digest = hashlib.sha1(usedforsecurity=False)
            whole = len(head) + len(stored) + 4 <= CHUNK
            cuts = [0] if whole else range(0, max(len(stored), 1), CHUNK)  # a long head alone is a row, too
            for k, at in enumerate(cuts):
                piece = stored[at : at + CHUNK]
                digest.update(piece)
                data = b"".join((head if k == 0 else b"", piece, b"\r\n\r\n" if k == len(cuts) - 1 else b""))
                held.append((record, k, len(cuts), data, digest.hexdigest()))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
            record += 1
    if held:
        yield batch_of(held)


def chunk_table(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """The archive of ``pages`` as ``record, chunk, chunks, data, running``; a caller writes it where it wants."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("html")).where("page_id is not null")
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    pages = pages.withColumn("sha", F.sha1(body))
    ids = pages.where(F.length(body) >= least).select("page_id", "sha")
    firsts = keep(ids.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1").select("sha", "first"), "firsts")
    refers = ids.join(firsts, "sha").where("first < page_id").distinct()
    rows = pages.join(refers, ["page_id", "sha"], "left").select("page_id", "url", "html", "sha", "first")
    return rows.mapInArrow(_written, "record long, chunk int, chunks int, data binary, running string")


class _Reader:
    """One record, fed chunk by chunk."""

    def __init__(self, data: bytes):
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not mark or lines[0] != "WARC/1.1":
            raise ValueError("no WARC record begins here")
        self.fields = dict(line.split(": ", 1) for line in lines[1:])
        http, mark, _ = rest.partition(b"\r\n\r\n")
        if not mark:
            raise ValueError("no HTTP head")
        self.size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
        self.left = int(self.fields["Content-Length"]) - len(http) - 4
        self.digest = hashlib.sha1(usedforsecurity=False)
        self.first = len(head) + len(http) + 8

    def feed(self, data: bytes, running: str, last: bool) -> None:
        view = memoryview(data)[self.first :]
        self.first = 0
        if last and bytes(view[-4:]) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        view = view[:-4] if last else view
        self.digest.update(view)
        self.left -= len(view)
        if self.digest.hexdigest() != running or self.left < 0 or (last and self.left):
            raise ValueError(f"payload of {self.fields.get('WARC-Record-ID')} is damaged")

    def row(self) -> tuple:
        kind, said = self.fields["WARC-Type"], self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and _base32(self.digest.digest()) != said:
            raise ValueError(f"payload digest of {self.fields['WARC-Record-ID']}")
        refers = self.fields.get("WARC-Refers-To")
        return self.fields["WARC-Record-ID"][1:-1], kind, self.fields["WARC-Target-URI"], refers and refers[1:-1], self.size, said


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows, those of a record in order and next to each other, to one row a record."""
    reader, want = None, (None, 0)
    for batch in batches:
        rows = []
        for record, chunk, chunks, data, running in zip(*(c if c.type == pa.binary() else c.to_pylist() for c in batch.columns), strict=True):
            if (record, chunk) != want and (reader or chunk):
                raise ValueError(f"chunk {chunk} of record {record} is out of order")
            body = data.as_py()
            reader = reader or _Reader(body)
            reader.feed(body, running, chunk == chunks - 1)
            want = (record, chunk + 1)
            if chunk == chunks - 1:
                rows.append(reader.row())
                reader = None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
    if reader:
        raise ValueError(f"record {want[0]} is cut short")


def read_table(chunks: DataFrame) -> DataFrame:
    """-> ``record_id, record_type, target, refers_to, payload_bytes, payload_digest`` for each record of an archive."""
    ddl = "record_id string, record_type string, target string, refers_to string, payload_bytes long, payload_digest string"
    chunks = chunks.select(_CHUNKS.names)
    long = chunks.where("chunks > 1").repartition("record").sortWithinPartitions("record", "chunk")
    return chunks.where("chunks = 1").mapInArrow(_read, ddl).unionByName(long.mapInArrow(_read, ddl))


def page_of(record_id: str):
    """The page id in a record id of ``chunk_table``."""
    return F.substring(record_id, len(_ID) + 1, 20).cast("long")
