import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from quirework.llm import quality, toxicity
from quirework.llm.samples import held_out, labelled_sample

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(n, seed):
    """Words of random letters; toxic documents hold an insult next to a group word; bad ones are symbol litter."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9)))
    docs, labels = [], []
    for d in range(n):
        words = [word() for _ in range(rng.randrange(20, 120))]
        toxic, bad = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zorkling", "quazzer", "vexbrat"])
        text = " ".join(w + rng.choice(["###", "%%%"]) for w in words) if bad else " ".join(words)
        docs.append((d, text))
        labels.append((d, int(not bad), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(900, 8)
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), labels


@pytest.mark.parametrize(("module", "column", "label"), [(toxicity, 2, "toxic"), (quality, 1, "quality")])
def test_held_out_accuracy(spark, tables, module, column, label):
    docs, labels, rows = tables
    model = module.fit(docs, labels)
    score = {r.doc_id: r.score for r in module.score(docs, model).collect()}
    unseen = [r.doc_id for r in docs.where(held_out(docs.doc_id)).collect()]
    truth = {r[0]: r[column] for r in rows}
    assert len(unseen) > 100
    assert np.mean([(score[d] >= 0.5) == truth[d] for d in unseen]) > 0.97


def test_machine_learns_a_pair():
    """Two terms that only count together: no sum of single weights separates this."""
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        noise = rng.integers(1000, 5000, 20)
        docs.append(np.unique(np.r_[noise, [11] * a, [22] * b].astype(np.int32)))
        labels.append(float(a and b))
    machine = toxicity.learn(docs, np.array(labels))
    z = lambda *buckets: machine.score([r for r in machine.row[list(buckets)].tolist() if r >= 0])
    assert z(11, 22) > 0.5 > max(z(11), z(22))
    odds = lambda p: np.log(p / (1 - p))
    assert odds(z(11, 22)) - odds(z(11)) - odds(z(22)) + odds(machine.score([])) > 0.05


def test_machine_learns_a_pair_that_tells_only_together():
    """Each term stands as often in clean as in toxic documents: only the two together tell (a XOR b)."""
    rng = np.random.default_rng(4)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(np.unique(np.r_[rng.integers(1000, 5000, 20), [11] * a, [22] * b].astype(np.int32)))
        labels.append(float(a != b))
    machine = toxicity.learn(docs, np.array(labels))
    z = lambda *buckets: machine.score([r for r in machine.row[list(buckets)].tolist() if r >= 0])
    assert min(z(11), z(22)) > 0.5 > max(z(11, 22), z())


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_input(spark, module):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "y" * 700_000), (5, "word " * 200_000)], DOCS).selectExpr("*", "'z' as label", "1 as score")
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (3, 0, None), (None, 1, 1), (99, 1, 1), (2, None, 0)], LABELS)
    for known in (labels, labels.limit(0)):
        rows = module.score(docs, module.fit(docs, known)).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert module.score(docs.limit(0), module.fit(docs.limit(0), labels)).count() == 0


def plain_units(text, again=True):
    """Buckets of a text with whole Python numbers: n-grams of padded words, words, pairs of neighbouring words."""
    m = 1 << 64

    def bucket(h):
        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 % m
        return h >> 64 - quality.BITS

    points = [32, *(32 if ord(c) in (32, *range(9, 14)) else ord(c) for c in text), 32]
    out = []
    for n in quality.GRAMS:
        for i in range(len(points) - n + 1):
            if 32 not in points[i + 1 : i + n - 1]:
                h = n
                for x in points[i : i + n]:
                    h = (h * quality._ROOT + x) % m
                out.append(bucket(h))
    words = [[ord(c) for c in w] for w in "".join(map(chr, points)).split(" ") if w]
    hashes = [sum(x * pow(quality._ROOT, k, m) for k, x in enumerate(w)) % m for w in words]
    out += map(bucket, hashes)
    return sorted(out + [quality._AGAIN if again and a == b else bucket((a * int(quality._PAIR) + b) % m) for a, b in zip(hashes, hashes[1:])])  # noqa: B905


TEXTS = ["ab  cd\tab ab", "", "Ünïcode wörds", "x", " lead", "ab ab", "one\x0btwo three  ", "y" * 40, "a bb ccc dddd eeeee ffffff " * 5, "\n\n"]


@pytest.mark.parametrize("again", [True, False])
def test_units_equal_plain_version_whatever_the_piece(monkeypatch, again):
    joined = [[] for _ in TEXTS]
    for buckets, owner in quality.units(TEXTS, again):
        for b, o in zip(buckets.tolist(), owner.tolist(), strict=True):
            joined[o].append(b)
    for text, found in zip(TEXTS, joined, strict=True):
        assert sorted(found) == plain_units(text, again)
        for piece in (1, 2, 3, 5, 8, 13, 1000):
            monkeypatch.setattr(quality, "PIECE", piece)
            cut = [b for x in quality.long_units(text, again) for b in x.tolist()]
            assert sorted(cut) == (plain_units(text, again) if text else []), (text, piece)


def test_repeated_words_without_their_unit(spark):
    """The method's own units find litter as well as with the unit; repeated words are what the unit is for."""
    docs, labels = corpus(700, 11)
    rng = random.Random(2)
    for k in range(0, 700, 7):
        words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(4)]
        docs[k], labels[k] = (k, " ".join(w for w in words for _ in range(25))), (k, 0, 0)
    tables = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    truth, unseen = {r[0]: r[1] for r in labels}, {r.doc_id for r in tables[0].where(held_out(tables[0].doc_id)).collect()}
    right = {}
    for again in (True, False):
        score = {r.doc_id: r.score for r in quality.score(tables[0], quality.fit(*tables, again=again)).collect()}
        right[again] = {d: (score[d] >= 0.5) == truth[d] for d in unseen}
    assert np.mean(list(right[True].values())) > 0.97
    assert np.mean([right[False][d] for d in unseen if d % 7]) > 0.95
    assert np.mean([right[True][d] for d in unseen if d % 7 == 0]) >= np.mean([right[False][d] for d in unseen if d % 7 == 0])


def test_quality_score_equals_plain_average():
    rng = np.random.default_rng(7)
    value = rng.normal(size=1 << quality.BITS).astype(np.float32)
    got = quality._scores(pa.array([*TEXTS, None]), value, 0.25)
    for text, score in zip([*TEXTS, ""], got, strict=True):
        found = plain_units(text)
        z = 0.25 + (sum(float(value[b]) for b in found) / len(found) if found else 0)
        assert score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)


def test_machine_score_equals_sum_over_pairs():
    rng = np.random.default_rng(5)
    w, v = rng.normal(size=9), rng.normal(size=(9, toxicity.FACTORS))
    machine = toxicity.Machine(-0.3, np.arange(9), w, v)
    for rows in ([], [4], [0, 3, 8], list(range(9))):
        z = -0.3 + sum(w[i] for i in rows) + sum(float(v[i] @ v[j]) for i in rows for j in rows if i < j)
        assert machine.score(rows) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)


def test_repeated_ids_have_one_text(spark):
    """Of several texts of an id the one with the smallest digest is learned from, in whatever order the rows come."""
    rows = [(k, f"{k} {t}") for k in range(40) for t in "abc"] + [(3, None), (4, "")]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], LABELS)
    want = {k: min((t or "" for d, t in rows if d == k), key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for k in range(40)}
    for order in (rows, rows[::-1]):
        sample = labelled_sample(spark.createDataFrame(order, DOCS).repartition(3), labels, "quality", 100).collect()
        assert sample and {r.doc_id: r.text for r in sample} == {r.doc_id: want[r.doc_id] for r in sample} and len({r.doc_id for r in sample}) == len(sample)


def test_telling_pairs_equal_plain_double_loop():
    rng = np.random.default_rng(12)
    docs = [np.unique(rng.integers(0, 40, rng.integers(1, 12))).astype(np.int32) for _ in range(400)]
    labels = np.array([float({3, 9} <= set(d.tolist()) or (5 in d) != (7 in d) and rng.random() < 0.8) for d in docs])
    seen = np.bincount(np.concatenate(docs), minlength=1 << toxicity.BITS)
    got = set(toxicity.telling_pairs(docs, labels, seen).tolist())
    share, want = labels.mean(), set()
    sets = [set(d.tolist()) for d in docs]
    for a in range(40):
        for b in range(a + 1, 40):
            cells = [[y for s, y in zip(sets, labels, strict=True) if (a in s, b in s) == (p, q)] for p, q in ((1, 1), (1, 0), (0, 1), (0, 0))]
            if min(map(len, cells)) < toxicity.LEAST_CELL or min(seen[a], seen[b], 400 - seen[a], 400 - seen[b]) < 2 * toxicity.LEAST_CELL:
                continue
            both, one, other, none = (np.mean(c) for c in cells)
            if (both - one - other + none) ** 2 >= toxicity.TELLING_PAIR * share * (1 - share) * sum(1 / len(c) for c in cells):
                want |= {a, b}
    assert want and want != set(range(40))
    assert got == want
