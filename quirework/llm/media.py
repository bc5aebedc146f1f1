"""Media columns: payloads stored as PNG in a binary column, read back with checks, and hashed.

A payload is a grey 8-bit image of 64 columns. Writing picks one filter a row (none, sub or up, by the smallest sum
of absolute differences) and cuts the zlib stream into IDAT chunks. Reading tests the signature and every chunk's
CRC-32, inflates, and undoes the filters with numpy (all five of the format). The feature is a 64-bit perceptual
hash: the image's mean over a 32 x 32 grid, its cosine transform, and one bit for each of the 8 x 8 lowest
frequencies above their median.

Defined cases: null and empty texts give one row of 64 zero bytes. Very long texts are one image each, written and read
whole. Every row gives one row, repeated rows and null ids included; equal texts give equal values. A broken file raises
``ValueError``. Extra columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Bytes of the zlib stream in one IDAT chunk.
CHUNK = 1 << 16
#: Bytes of media that a result batch holds at most, but for a single larger one.
BATCH_BYTES = 16 << 20


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def write_png(payload: bytes) -> bytes:
    """``payload`` (a positive multiple of 64 bytes) as a grey image of 64 columns."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    sub, up = rows.copy(), rows.copy()
    sub[:, 1:] -= rows[:, :-1]
    up[1:] -= rows[:-1]
    cost = [np.abs(x.view(np.int8).astype(np.int16)).sum(1) for x in (rows, sub, up)]
    kind = np.argmin(cost, 0)
    lines = np.empty((len(rows), WIDTH + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = np.choose(kind[:, None], (rows, sub, up))
    stream = zlib.compress(lines.tobytes(), 6)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    body = b"".join(_chunk(b"IDAT", stream[i : i + CHUNK]) for i in range(0, len(stream), CHUNK))
    return SIGNATURE + _chunk(b"IHDR", head) + body + _chunk(b"IEND", b"")


def _paeth(a: int, b: int, c: int) -> int:
    p = a + b - c
    return min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]


def _unfiltered(kind: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo row filters of a one-byte-a-pixel image, run by run of equal filters."""
    out = np.empty_like(rows)
    cuts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        part, above = rows[lo:hi], out[lo - 1] if lo else np.zeros(rows.shape[1], np.uint8)
        match int(kind[lo]):
            case 0:
                out[lo:hi] = part
            case 1:
                out[lo:hi] = np.cumsum(part, axis=1, dtype=np.uint8)
            case 2:
                out[lo:hi] = np.cumsum(np.vstack([above[None], part]), axis=0, dtype=np.uint8)[1:]
            case 3 | 4 as code:
                for r in range(lo, hi):
                    up, left, corner = (out[r - 1] if r else np.zeros(rows.shape[1], np.uint8)).tolist(), 0, 0
                    line = []
                    for x, b in zip(rows[r].tolist(), up, strict=True):
                        left = (x + ((left + b) // 2 if code == 3 else _paeth(left, b, corner))) & 255
                        corner = b
                        line.append(left)
                    out[r] = line
            case other:
                raise ValueError(f"unknown filter {other}")
    return out


def read_png(data: bytes) -> np.ndarray:
    """Pixels of a grey 8-bit PNG without interlacing, after all checks."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, parts, ended, inflate = 8, None, [], False, zlib.decompressobj()
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("a chunk is cut short")
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        if at + 12 + n > len(data) or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if (depth, colour, interlace) != (8, 0, 0):
                raise ValueError("only grey 8-bit images without interlacing")
            size = height, width
        elif kind == b"IDAT":
            try:
                parts.append(inflate.decompress(body))
            except zlib.error as error:
                raise ValueError("broken zlib stream") from error
        ended = kind == b"IEND"
        at += 12 + n
    raw = b"".join([*parts, inflate.flush()])
    if not ended or size is None or len(raw) != size[0] * (size[1] + 1):
        raise ValueError("the image is not whole")
    lines = np.frombuffer(raw, np.uint8).reshape(size[0], size[1] + 1)
    return _unfiltered(lines[:, 0], lines[:, 1:])


GRID, LOW = 32, 8
_COSINE = np.cos(np.pi / GRID * (np.arange(GRID)[None, :] + 0.5) * np.arange(LOW)[:, None])


def cosine_hash(pixels: np.ndarray) -> bytes:
    """8 bytes: bit k tells whether low frequency k (row by row, the constant one is 0) exceeds the median of the others."""
    height, width = pixels.shape
    sums = np.zeros((height + 1, width + 1), np.int64)
    sums[1:, 1:] = pixels.cumsum(0, dtype=np.int64).cumsum(1)
    edges = [(np.arange(GRID) * n // GRID, np.maximum((np.arange(GRID) + 1) * n // GRID, np.arange(GRID) * n // GRID + 1)) for n in (height, width)]
    (r0, r1), (c0, c1) = edges
    total = sums[np.ix_(r1, c1)] - sums[np.ix_(r0, c1)] - sums[np.ix_(r1, c0)] + sums[np.ix_(r0, c0)]
    means = total / np.outer(r1 - r0, c1 - c0)
    low = np.round(_COSINE @ means @ _COSINE.T, 6).ravel()  # what is zero shall be zero on every machine
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes()


def _batches(rows: Iterator[tuple], names: list[str], types: list) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, n_bytes, media``: each text's UTF-8 bytes, filled with zero bytes to a positive multiple of 64, as PNG."""

    def rows(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                yield key, len(raw), write_png(raw + b"\0" * (-len(raw) % WIDTH if raw else WIDTH))

    run = lambda batches: _batches(rows(batches), ["doc_id", "n_bytes", "media"], [pa.int64(), pa.int64(), pa.binary()])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def load(stored: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media`` -> these, ``payload`` (bytes read back) and ``hash`` (8 bytes)."""

    def rows(batches):
        for batch in batches:
            for key, n, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                pixels = read_png(data := media.as_py())
                yield key, n, data, pixels.tobytes(), cosine_hash(pixels)

    names, types = ["doc_id", "n_bytes", "media", "payload", "hash"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(lambda b: _batches(rows(b), names, types), "doc_id long, n_bytes long, media binary, payload binary, hash binary")
