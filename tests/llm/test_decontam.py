import random
import re
import tracemalloc

import numpy as np

from quirework.llm import decontam
from quirework.llm.decontam import contamination, decontaminated

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = {}
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, said in items:
            v = words(said)
            for o in range(max(1, len(v) - 9) if v else 0):
                win = v[o : o + 10]
                for i in range(len(w) - len(win) + 1):
                    if w[i : i + len(win)] == win:
                        hit.update(range(i, i + len(win)))
                        ids.add(item)
        out[doc] = (len(w), len(hit), sorted(map(str, ids)))
    return out


def case(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(12)] + ["Über", "x1"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((0, 1, 3, 9, 10, 11, 25))))) for i in range(30, 45)] + [(7, None)]
    docs = []
    for d in range(40):
        parts = rng.choices(vocab + ["other", "más"], k=rng.randrange(40))
        for _ in range(rng.randrange(3)):
            v = rng.choice(items)[1] or ""
            parts[rng.randrange(len(parts) + 1) : 0] = v.upper().replace("Ü", "ü").split() if rng.random() < 0.5 else v.split()
        docs.append((d, ", ".join(parts)))
    return docs + [(100, None), (101, ""), (102, "..."), (103, docs[3][1])], items


def got(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in contamination(d, i).collect()}


def test_equals_brute_force(spark, monkeypatch):
    docs, items = case(3)
    assert got(spark, docs, items) == brute(docs, items)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 200)
    assert got(spark, docs, items) == brute(docs, items)


def test_long_match_is_one_row_with_its_place(spark):
    item = " ".join(f"k{i}" for i in range(25))
    docs = [(1, f"a b {item} c"), (2, "a b c")]
    rows = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, f"z {item}")], "item_id long, text string")).collect()
    assert {r.doc_id: [tuple(m) for m in r.matches] for r in rows} == {1: [(9, 1, 2, 25)], 2: []}


def test_removal_keeps_clean_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j", "x"), (2, "a b", "y"), (None, "q", "z")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(5, "A b c d e f g h i j")], "item_id long, text string")
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {(2, "a b", "y"), (None, "q", "z")}
    assert decontaminated(docs, items.limit(0)).count() == 3
    assert decontaminated(docs.limit(0), items).count() == 0


def test_blocks_change_no_row(spark, monkeypatch):
    """Repeated ids with other texts, null ids, extra columns and a text of a megabyte, in one block and in many."""
    docs, items = case(4)
    rows = [(d, t, 1) for d, t in docs] + [(docs[0][0], docs[5][1], 2), (docs[0][0], docs[9][1], 2), (None, docs[5][1], 3), (None, docs[9][1], 3), (500, "long words " * 90_000 + items[-2][1], 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words long").selectExpr("*", "1 as matches").repartition(3)
    items = spark.createDataFrame(items + items[:3], "item_id long, text string").selectExpr("*", "text as doc_id")
    one = sorted(map(str, contamination(frame, items).collect()))
    clean = sorted(map(str, decontaminated(frame, items).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 100)
    assert len(one) == len(rows) and sorted(map(str, contamination(frame, items).collect())) == one
    assert sorted(map(str, decontaminated(frame, items).collect())) == clean
    by_text = {t: v for (_, t), v in zip(docs, brute([(k, t) for k, (_, t) in enumerate(docs)], case(4)[1]).values(), strict=True)}
    twice = [r for r in contamination(frame, items).collect() if r.doc_id == docs[0][0]]
    assert sorted((r.n_words, r.n_hit) for r in twice) == sorted(by_text[docs[k][1]][:2] for k in (0, 5, 9))


def test_equal_words_take_no_more_than_the_shard(spark):
    """An item of 4 000 equal words against a text of 200 000 such words: one window, few matches, little memory."""
    probe = decontam.Probe([(1, 0, "ha " * 4_000), (2, 0, "ha " * 4_000), (3, 0, "ha ho")], 10)
    tracemalloc.start()
    words = np.full(200_000, probe.number[b"ha"], np.int32)
    position, window = decontam.starts(words, probe)
    found = decontam.longest(position, window, 0, probe)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(position) == 200_000 - 9 and len(probe.length) == 2
    assert found == (0, 0, 4_000) and peak < 1 << 28
    docs = spark.createDataFrame([(7, "ha " * 20_000), (8, "ho ha ho")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "ha " * 400), (2, "ha " * 400), (3, "ha ho")], "item_id long, text string")
    assert {r.doc_id: (r.n_hit, r["items"]) for r in contamination(docs, items).collect()} == {7: (20_000, ["1", "2"]), 8: (2, ["3"])}


def test_matches_are_the_longest_stretches(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("ab", k=60))) for i in range(6)]
    docs = [(d, " ".join(rng.choices("ab", k=100))) for d in range(5)]
    got = {r.doc_id: {tuple(m) for m in r.matches} for r in contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for doc, text in docs:
        w, want = text.split(), set()
        for item, said in items:
            v, best = said.split(), (0, 0, 0)
            for p in range(len(w)):
                for o in range(len(v)):
                    n = 0
                    while o + n < len(v) and p + n < len(w) and v[o + n] == w[p + n]:
                        n += 1
                    best = max(best, (n, -p, -o))
            if best[0] >= 10:
                want.add((item, -best[2], -best[1], best[0]))
        assert got[doc] == want


def test_cut_items_lose_no_window(spark, monkeypatch):
    docs, items = case(8)
    items.append((99, " ".join(f"w{i % 7}" for i in range(90))))
    docs.append((200, "x " + " ".join(f"w{i % 7}" for i in range(40, 90))))
    monkeypatch.setattr(decontam, "PIECE_WORDS", 11)
    monkeypatch.setattr(decontam, "PAIRS", 3)
    assert got(spark, docs, items) == brute(docs, items)
