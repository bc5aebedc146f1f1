"""Formulas, terms, image files and the readiness stream, against plain versions."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.operators import formulas, images, terms
from quirework.plans.lines import md_lines
from quirework.streaming import incremental, readiness


def plain_symbols(latex):
    plain = re.sub(rf"{formulas.NOISE}(?=[^A-Za-z]|$)", " ", latex or "")
    return [formulas.SAME.get(s, s) for s in re.findall(formulas.SYMBOL, plain)]


def plain_drift(summary, source):
    out = set()
    for doc, i, latex in summary:
        ours, best = Counter(plain_symbols(latex)), None
        for other, j, said in source:
            theirs = Counter(plain_symbols(said))
            if other == doc and ours and (likeness := Fraction((ours & theirs).total(), (ours | theirs).total())) >= formulas.LEAST:
                best = min(best or (1, 0, None), (-likeness, j, theirs), key=lambda b: b[:2])
        theirs = best[2] if best else Counter()
        missing, extra = sorted((theirs - ours).elements()), sorted((ours - theirs).elements())
        if ours and (not best or missing or extra):
            out.add((doc, i, best[1] if best else None, tuple(missing), tuple(extra)))
    return out


def test_formula_drift_equals_plain_version(spark):
    rng = random.Random(7)
    pool = ["\\emptyset", "0", "\\cap", "\\cup", "x", "y", "A", "B", "=", "\\le", "\\leqslant", "\\pmb", "\\mathcal{R}", "^{2}", "_{n}", "\\,", "\\subset", "1", "\\{", "\\left("]
    source = [(d, j, " ".join(rng.choices(pool, k=rng.randrange(1, 14)))) for d in range(25) for j in range(6)]
    summary = []
    for d, j, latex in source:
        parts = latex.split()
        if rng.random() < 0.5:
            parts[rng.randrange(len(parts))] = rng.choice(pool)
        summary.append((d, 100 + j, " ".join(parts)))
    summary += [(3, 999, ""), (3, 998, None), (77, 1, "x")]
    schema = "doc_id long, id long, latex string"
    rows = formulas.drift(spark.createDataFrame(summary, schema), spark.createDataFrame(source, schema)).collect()
    got = {(r.doc_id, r.id, r.source_id, tuple(r.missing), tuple(r.extra)) for r in rows}
    assert got == plain_drift(summary, source) and {r.source_id for r in rows} > {None}
    assert formulas.drift(spark.createDataFrame(summary, schema), spark.createDataFrame([], schema)).where("source_id is not null").count() == 0


def test_terms_equal_plain_version_with_a_large_dictionary(spark):
    rng = random.Random(8)
    signs = "度量空间连续映射紧致拓扑abcde "
    words = sorted({"".join(rng.choices(signs, k=rng.randrange(2, 6))) for _ in range(16_000)})[:10_000]
    names = {w: f"Name {k}" for k, w in enumerate(words)}
    docs = []
    for d in range(12):
        text = "".join(rng.choice(words) + rng.choice(["", "", f" ({rng.choice(['name 1', 'x'])})", "\n"]) for _ in range(40))
        w = rng.choice(words)
        docs.append((d, f"**{w}**（{names[w].upper()}）{text}"))
    docs += [(50, ""), (51, "x"), (52, None)]
    table = spark.createDataFrame([*names.items(), ("a", "One sign")], "term string, english string")
    got = {tuple(r) for r in terms.without_english(md_lines(spark.createDataFrame(docs, "doc_id long, text string")), table).collect()}
    want = set()
    for d, text in docs:
        for w in words:
            for n, line in enumerate((text or "").split("\n"), 1):
                if (at := line.find(w)) >= 0:
                    if not re.match(rf"[*\s”」』]*[(（]\s*{re.escape(names[w])}", line[at + len(w) :], re.I):
                        want.add((d, w, n, at))
                    break
    assert got == want and len(words) == 10_000 and len(want) > 100


def test_terms_are_found_in_pieces_and_blocks_without_a_row_a_place(spark, monkeypatch):
    """Long terms, long lines and a dictionary in blocks, whatever the sizes; no place of a text becomes a row."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("ab度", k=rng.choice((2, 3, 5, 17, 18, 40, 70)))) for _ in range(300)})
    words += ["q" * 30 + x for x in "abc"]
    docs = [(d, "\n".join("".join(rng.choice([*words, "b", " ("]) for _ in range(30)) for _ in range(3))) for d in range(8)]
    docs.append((8, "q" * 900 + "c (x" + "q" * 29 + "a"))
    table = spark.createDataFrame([(w, w.upper()) for w in words], "term string, english string")
    want = set()
    for d, text in docs:
        for w in words:
            n, line = next(((n, x) for n, x in enumerate(text.split("\n"), 1) if w in x), (0, ""))
            if n:
                want.add((d, w, w.upper(), n, line.find(w), line[line.find(w) + len(w) :][:200]))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for piece, block in ((1 << 20, 4 << 20), (64, 1000)):
        monkeypatch.setattr(terms, "PIECE_CHARS", piece)
        monkeypatch.setattr(terms, "BLOCK_CHARS", block)
        rows = terms.first_uses(md_lines(frame), table)
        assert {tuple(r) for r in rows.collect()} == want and len(want) > 500
    monkeypatch.undo()
    lines = spark.createDataFrame([(1, 1, "ab")], "doc_id long, line_no int, line string")
    assert "Generate" not in terms.first_uses(lines, table)._jdf.queryExecution().executedPlan().toString()


def png(pixels, colour, filters, depth=8, palette=None):
    height, width = pixels.shape[:2]
    flat = pixels.reshape(height, -1).astype(np.uint8)
    step, raw, above = flat.shape[1] // width, b"", np.zeros(flat.shape[1], np.int64)
    for y in range(height):
        row, kind = flat[y].astype(np.int64), filters[y % len(filters)]
        left, corner = np.r_[np.zeros(step, np.int64), row[:-step]], np.r_[np.zeros(step, np.int64), above[:-step]]
        p = left + above - corner
        near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        raw += bytes([kind]) + ((row - [0, left, above, (left + above) // 2, near][kind]) % 256).astype(np.uint8).tobytes()
        above = row
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    head = width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([depth, colour, 0, 0, 0])
    extra = chunk(b"PLTE", palette.tobytes()) if palette is not None else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + extra + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_faults_of_files_on_disk(spark, tmp_path):
    rng = np.random.default_rng(3)
    grey, colour = rng.integers(0, 256, (30, 25, 1)), rng.integers(0, 256, (40, 33, 3))
    palette = rng.integers(0, 256, (8, 3)).astype(np.uint8)
    nth = rng.integers(0, 8, (22, 21, 1))
    bright = lambda x: np.rint(x.astype(float) @ np.array(images.GREY))
    good = {
        "grey.png": (png(grey, 0, [0, 1, 2, 3, 4]), (25, 30, grey.var())),
        "colour.png": (png(colour, 2, [4, 3, 2, 1, 0]), (33, 40, bright(colour).var())),
        "alpha.png": (png(np.dstack([colour, colour[:, :, :1]]), 6, [1, 4]), (33, 40, bright(colour).var())),
        "palette.png": (png(nth, 3, [2], palette=palette), (21, 22, bright(palette[nth[:, :, 0]]).var())),
        "map.pgm": (b"P5\n# a comment\n25 30\n255\n" + grey.astype(np.uint8).tobytes(), (25, 30, grey.var())),
        "flat.png": (png(np.full((50, 50, 1), 9), 0, [0]), (50, 50, 0.0)),
        "thin.png": (png(grey[:5], 0, [0]), (25, 5, grey[:5].var())),
    }
    bad = {"cut.png": good["grey.png"][0][:60], "sum.png": good["grey.png"][0].replace(b"IDAT", b"IDAX"), "text.png": b"hello"}
    for name, data in {**{k: v[0] for k, v in good.items()}, **bad}.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty.png").write_bytes(b"")
    files = images.image_files(spark, str(tmp_path))
    told = {r.file: r for r in images.image_facts(files).collect()}
    for name, (_, (width, height, variance)) in good.items():
        assert (told[name].width, told[name].height, told[name].why) == (width, height, None)
        assert told[name].variance == pytest.approx(variance, rel=1e-9)
    assert all(told[name].width is None and told[name].why for name in bad)
    index = spark.createDataFrame([(1, n) for n in [*good, *bad, "gone.png", "empty.png"]], "ch int, file string")
    got = {(r.file, r.severity, r.fault) for r in images.checked(index, files).collect()}
    assert got == {(n, "blocks", "unreadable") for n in bad} | {("gone.png", "blocks", "missing"), ("empty.png", "blocks", "missing"), ("flat.png", "warns", "blank"), ("thin.png", "blocks", "small")}


def test_chapters_are_told_once_after_a_restart(spark, tmp_path):
    """Pages out of order and twice, in three runs of the stream on one checkpoint: each chapter comes once, when it is whole."""
    chapters = spark.createDataFrame([(1, 1, 1, 3), (1, 2, 3, 6), (2, 1, 1, 2), (2, 9, 5, 2_000_000_000)], "book long, ch int, start int, end int")
    lots = [[(1, 3), (1, 1), (2, 2), (2, 7)], [(1, 2), (1, 2), (1, 6), (2, 2)], [(1, 5), (1, 4), (2, 1), (1, 1), (3, 1)]]
    source, seen = f"{tmp_path}/in", {"ready": [], "passed": []}
    for lot in lots:
        spark.createDataFrame(lot, "book long, page int").coalesce(1).write.mode("append").parquet(source)
        for name, make in (("ready", readiness.readied), ("passed", readiness.passed)):
            stream = make(incremental.arriving(spark, source, "book long, page int"), chapters)
            query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/{name}-state").trigger(availableNow=True).start(f"{tmp_path}/{name}")
            query.awaitTermination()
            rows = spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}").collect()
            seen[name].append(sorted((r.book, r.ch) for r in rows))
    assert seen["ready"] == [[], [(1, 1)], [(1, 1), (1, 2), (2, 1)]]
    assert seen["passed"] == [[(1, 1), (2, 1)], [(1, 1), (1, 2), (2, 1)], [(1, 1), (1, 2), (2, 1)]]
    whole = spark.read.schema(readiness.OUT).parquet(f"{tmp_path}/ready")
    assert {(r.ch, r.book): (r.state, r.pages) for r in whole.collect()} == {(1, 1): ("ready", 3), (2, 1): ("ready", 4), (1, 2): ("ready", 2)}
    batch = spark.read.schema("book long, page int").parquet(source)
    assert sorted((r.book, r.ch) for r in incremental.ready(chapters.where(F.col("end") < 100), batch).collect()) == seen["ready"][-1]
