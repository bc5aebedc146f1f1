import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import media


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=700))
def test_round_trip(raw):
    payload = raw + b"\0" * (-len(raw) % 64)
    assert media.read_png(media.write_png(payload)).tobytes() == payload


def plain_filter(pixels, kinds):
    """The format's five filters, byte by byte."""
    out = b""
    for r, kind in enumerate(kinds):
        out += bytes([kind])
        for c in range(pixels.shape[1]):
            a = int(pixels[r, c - 1]) if c else 0
            b = int(pixels[r - 1, c]) if r else 0
            d = int(pixels[r - 1, c - 1]) if r and c else 0
            p = a + b - d
            near = sorted(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d)))[0][2]
            out += bytes([(int(pixels[r, c]) - [0, a, b, (a + b) // 2, near][kind]) % 256])
    return out


def test_all_filters_are_undone():
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (40, 17), dtype=np.uint8)
    kinds = rng.integers(0, 5, 40).tolist()
    parts = [media._chunk(b"IHDR", struct.pack(">IIBBBBB", 17, 40, 8, 0, 0, 0, 0)), media._chunk(b"tEXt", b"a\0b"), media._chunk(b"IDAT", zlib.compress(plain_filter(pixels, kinds))), media._chunk(b"IEND", b"")]
    assert (media.read_png(media.SIGNATURE + b"".join(parts)) == pixels).all()


def test_damage_is_noticed():
    good = media.write_png(bytes(range(64)) * 3)
    for at in (0, 20, 45, len(good) - 20):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            media.read_png(bytes(bad))
    with pytest.raises(ValueError):
        media.read_png(good[:-12])


def test_table(spark):
    rows = [(1, "abc"), (2, None), (3, ""), (4, "abc"), (None, "é" * 500), (6, "x" * 64)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", media.F.lit(1))
    got = media.load(media.store(frame)).collect()
    assert len(got) == 6
    for r in got:
        raw = dict(rows)[r.doc_id] or ""
        raw = raw.encode()
        assert r.n_bytes == len(raw) and bytes(r.payload).rstrip(b"\0") == raw and len(r.payload) % 64 == 0 and len(r.payload) >= 64 and len(r.hash) == 8
    same = {r.doc_id: (bytes(r.media), bytes(r.hash)) for r in got}
    assert same[1] == same[4] and same[2] == same[3]
    assert media.load(media.store(frame.limit(0))).count() == 0


def plain_hash(pixels):
    """Means over the grid and their cosine transform, cell by cell."""
    import math

    height, width = len(pixels), len(pixels[0])
    edge = lambda k, n: (k * n // media.GRID, max((k + 1) * n // media.GRID, k * n // media.GRID + 1))
    means = []
    for r in range(media.GRID):
        (a, b), row = edge(r, height), []
        for c in range(media.GRID):
            lo, hi = edge(c, width)
            cells = [pixels[y][x] for y in range(a, b) for x in range(lo, hi)]
            row.append(sum(cells) / len(cells))
        means.append(row)
    wave = lambda u, k: math.cos(math.pi / media.GRID * (k + 0.5) * u)
    low = [round(sum(means[r][c] * wave(u, r) * wave(v, c) for r in range(media.GRID) for c in range(media.GRID)), 6) for u in range(media.LOW) for v in range(media.LOW)]
    rest = sorted(low[1:])
    bits = [0] + [int(x > rest[len(rest) // 2]) for x in low[1:]]
    return bytes(int("".join(map(str, bits[i : i + 8])), 2) for i in range(0, 64, 8))


def test_hash_equals_plain_cosine_transform():
    rng = np.random.default_rng(3)
    for height in (1, 7, 40, 200):
        pixels = rng.integers(0, 256, (height, media.WIDTH)).astype(np.uint8)
        assert media.cosine_hash(pixels) == plain_hash(pixels.tolist())


def test_query_equals_plain_version(spark):
    import hashlib
    import zlib

    from quirework.llm.queries import op7_media

    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op7_media(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc, text in docs:
        raw = (text or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        r, stored = got[doc], media.write_png(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), media.cosine_hash(np.frombuffer(payload, np.uint8).reshape(-1, 64)).hex())


def test_long_text_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "wörd " * 300_000), (2, None)], "doc_id long, text string").selectExpr("*", "1 as media")
    got = {r.doc_id: r for r in media.load(media.store(frame)).collect()}
    assert bytes(got[1].payload).rstrip(b"\0").decode() == "wörd " * 300_000 and bytes(got[2].payload) == b"\0" * 64
    assert media.load(media.store(frame.limit(0))).count() == 0
