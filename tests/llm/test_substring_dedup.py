import random
import re

from quirework.llm import substring_dedup
from quirework.llm.substring_dedup import LEAST_WORDS, remove_repeats, repeated_spans, without

SCHEMA = "doc_id long, text string"


def brute(rows, least=LEAST_WORDS):
    """(doc, start, end, kept doc, kept start) of lines and sentences, by comparing normalised strings."""
    rows = sorted({(d, t) for d, t in rows if d is not None and t})
    found = []
    for doc, text in rows:
        at = 0
        for line in text.split("\n"):
            parts, lo = [(at, at + len(line))], 0
            for m in re.finditer(r"(?<=[.!?])\s+", line):
                parts.append((at + lo, at + m.start()))
                lo = m.end()
            if lo:
                parts.append((at + lo, at + len(line)))
            found += [(doc, s, e, at, at + len(line), " ".join(text[s:e].lower().split())) for s, e in parts if len(text[s:e].split()) >= least]
            at += len(line) + 1
    first = {}
    for doc, s, _, _, _, norm in sorted(found):
        first.setdefault(norm, (doc, s))
    gone = [x for x in found if first[x[5]] != (x[0], x[1])]
    lines = {(d, ls) for d, s, e, ls, le, _ in gone if (s, e) == (ls, le)}
    return {(d, s, e, *first[n]) for d, s, e, ls, le, n in gone if (s, e) == (ls, le) or (d, ls) not in lines}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(3, 14))).capitalize() + rng.choice(".!?")
    pool = [" ".join(sentence() for _ in range(rng.randrange(1, 5))) for _ in range(12)]
    rows = []
    for d in range(50):
        lines = []
        for _ in range(rng.randrange(5)):
            x = rng.random()
            lines.append(rng.choice(pool) if x < 0.4 else f"{sentence()} {rng.choice(pool)} {sentence()}" if x < 0.6 else rng.choice(pool).upper() if x < 0.7 else sentence())
        rows.append((d * 13 % 51, "\n".join(lines)))
    return rows


def spans(frame, **more):
    return {(r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in repeated_spans(frame, **more).collect()}


def test_equals_brute_force(spark):
    rows = corpus(7) + [(100, None), (101, ""), (None, corpus(7)[3][1])]
    rows += rows[:1]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert want and spans(frame) == want


def test_packing_and_ranges_change_nothing(spark, monkeypatch):
    """Small batches and many hash ranges; every line and sentence counts at ``least`` 1; a text of a megabyte."""
    rows = corpus(8) + [(300, "\n".join(f"line {i} of a very long text that goes on" for i in range(25_000))), (301, "x. line 77 of a very long text that goes on")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = {k: brute(rows, k) for k in (1, 2, 8)}
    for k in want:
        assert spans(frame, least=k) == want[k]
    monkeypatch.setattr(substring_dedup, "PACK_UNITS", 50)
    monkeypatch.setattr(substring_dedup, "RANGE_CHARS", 1000)
    assert spans(frame) == want[8]


def test_clashing_columns(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    frame = spark.createDataFrame([(1, passage, 7, 8, 9), (2, passage, 7, 8, 9)], "doc_id long, text string, _doc long, _SPANS long, kept long")
    assert sorted(map(tuple, remove_repeats(frame).collect())) == [(1, passage, 7, 8, 9), (2, "", 7, 8, 9)]


def test_first_occurrence_stays_and_text_is_rebuilt(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(5, f"intro five\n{passage}\nend", 1, "k"), (2, f"begin. {passage}. tail of it", 1, "k"), (9, f"{passage}\n{passage}", 1, "k"), (None, passage, 1, "k"), (7, None, 1, "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, start string")
    out = remove_repeats(frame)
    assert out.columns == frame.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {5: f"intro five\n{passage}\nend", 2: rows[1][1], 9: "", None: passage, 7: None}
    assert {r.n_chars for r in out.where("doc_id = 9").collect()} == {0}
    assert remove_repeats(frame.limit(0)).count() == 0


def test_without():
    assert without("aa bb cc", [(3, 5)]) == "aa cc"
    assert without("aa\nbb", [(0, 2), (3, 5)]) == ""
    assert without("abcdef", [(1, 4), (2, 3)]) == "aef"


def test_passages_of_short_pieces_go(spark):
    """Verse, short sentences, a short last sentence and lines without blanks, each inside different text."""
    verse = "\n".join(f"a{i} b{i} c{i}" for i in range(20))
    talk = " ".join(f"D{i} e{i} f{i}." for i in range(20))
    bang = "!!".join(f"g{i} h{i}" for i in range(30))
    last = " ".join(f"k{i}" for i in range(50)) + ". So it ends."
    han = "。".join("".join(chr(0x4E00 + 97 * i + j) for j in range(6)) for i in range(10)) + "。"
    thai = "".join(chr(0x0E01 + i * 7 % 46) for i in range(60))
    rows = []
    for k, passage in enumerate((verse, talk, bang, last, han, thai)):
        around = "\n" if passage in (verse, han, thai) else " "
        rows += [(10 * k + d, f"x{d}{k} only {d} here.{around}{passage}{around}y{d}{k} tail {d} of it") for d in range(2)]
    song = "\n".join(["la la la"] * 10)
    rows.append((99, song))
    got = {r.doc_id: r.text for r in remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for k in range(6):
        assert got[10 * k] == dict(rows)[10 * k]
        left = got[10 * k + 1].split()
        assert len(got[10 * k + 1]) < 50 and left[:4] == [f"x1{k}", "only", "1", "here."], (k, got[10 * k + 1])
    assert got[99].split() == ["la"] * 9
