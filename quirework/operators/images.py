"""Image files: size and variance of their brightness, computed where Spark reads them.

PNG (any bit depth, palette and transparency included, not interlaced) and the portable grey and colour maps P5 and P6 are decoded
with zlib and numpy, one file at a time in a task; anything else counts as unreadable, with the reason.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Weights of red, green and blue in brightness, samples of a pixel by PNG's colour type.
GREY = (0.299, 0.587, 0.114)
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """PNG's rows without their filters; ``step`` is the distance of a byte from its left neighbour."""
    rows = np.frombuffer(raw, np.uint8)[: height * (stride + 1)].reshape(height, stride + 1)
    out = np.zeros((height, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(height):
        kind, row = rows[y, 0], rows[y, 1:]
        if kind == 0:
            now = row
        elif kind == 1:
            now = np.add.accumulate(np.pad(row, (0, -stride % step)).reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:stride]
        elif kind == 2:
            now = row + above
        elif kind in (3, 4):
            now, up = bytearray(row.tobytes()), above.tolist()
            for x in range(stride):
                left, corner = (now[x - step], up[x - step]) if x >= step else (0, 0)
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up[x]), 1, up[x]), (abs(p - corner), 2, corner))[2]
                now[x] = (now[x] + guess) & 255
            now = np.frombuffer(bytes(now), np.uint8)
        else:
            raise ValueError(f"filter {kind}")
        out[y] = above = now
    return out


def _png(data: bytes) -> np.ndarray:
    at, header, palette, body = 8, None, None, []
    while at + 8 <= len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        chunk = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + chunk) != int.from_bytes(data[at + 8 + size : at + 12 + size], "big"):
            raise ValueError(f"checksum of {kind.decode('latin-1')}")
        if kind == b"IHDR":
            header = (int.from_bytes(chunk[:4], "big"), int.from_bytes(chunk[4:8], "big"), chunk[8], chunk[9], chunk[12])
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(chunk)
        at += 12 + size
    if not header:
        raise ValueError("no header")
    width, height, depth, colour, interlaced = header
    if interlaced:
        raise ValueError("interlaced")
    samples = SAMPLES[colour]
    stride, step = (width * samples * depth + 7) // 8, max(1, samples * depth // 8)
    rows = _unfiltered(zlib.decompress(b"".join(body)), height, stride, step)
    if depth < 8:
        bits = np.unpackbits(rows, axis=1)[:, : width * depth].reshape(height, width, depth)
        rows = (bits * (1 << np.arange(depth)[::-1])).sum(axis=2)
        rows = rows if colour == 3 else rows * 255 // ((1 << depth) - 1)
    elif depth == 16:
        rows = rows[:, ::2]
    pixels = rows.reshape(height, width, samples)
    if colour == 3:
        return palette[pixels[:, :, 0]]
    return pixels[:, :, : 1 if colour in (0, 4) else 3]


def _portable(data: bytes) -> np.ndarray:
    found = re.match(rb"P([56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", data)
    if not found or int(found[4]) > 255:
        raise ValueError("no portable map of bytes")
    width, height, samples = int(found[2]), int(found[3]), 1 if found[1] == b"5" else 3
    return np.frombuffer(data, np.uint8, width * height * samples, found.end()).reshape(height, width, samples)


def facts(data: bytes | None) -> tuple[int | None, int | None, float | None, str | None]:
    """(width, height, population variance of brightness, null), or nulls and why the file can't be read."""
    try:
        pixels = _png(data) if data[:8] == b"\x89PNG\r\n\x1a\n" else _portable(data)
        grey = pixels[:, :, 0].astype(np.float64) if pixels.shape[2] == 1 else np.rint(pixels.astype(np.float64) @ np.array(GREY))
        return pixels.shape[1], pixels.shape[0], float(grey.var()) if grey.size else 0.0, None
    except Exception as why:  # a broken file is a finding, whatever breaks
        return None, None, None, f"{type(why).__name__}: {why}"[:200]


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, content`` of every file of a folder."""
    return spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def image_facts(files: DataFrame) -> DataFrame:
    """``file, content`` -> ``file, width, height, variance, why``; an unreadable file has nulls and a reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [facts(content.as_py()) for content in batch.column(1)]
            columns = [pa.array([t[k] for t in told], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["file", "width", "height", "variance", "why"])

    return files.select(F.col("file").cast("string"), "content").mapInArrow(run, "file string, width int, height int, variance double, why string")


def checked(index: DataFrame, files: DataFrame) -> DataFrame:
    """``ch, file, severity, fault`` of the figures ``ch, file`` of an index: missing, unreadable, small or nearly blank files.

    Spark's reader leaves files of no bytes out: they count as missing.
    """
    from .figures import file_faults

    known = index.select("ch", "file")
    held = files.join(known.select("file").distinct(), "file", "left_semi")
    faults = file_faults(image_facts(held)).join(known, "file")
    missing = known.join(files.select("file"), "file", "left_anti").select("ch", "file", F.lit("blocks").alias("severity"), F.lit("missing").alias("fault"))
    return missing.unionByName(faults.select("ch", "file", "severity", "fault"))
