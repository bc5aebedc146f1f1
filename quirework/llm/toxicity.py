"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words (A-Z and other letters lower-cased, runs of letters) and the words' first four,
five and six letters, hashed into ``2 ** BITS`` buckets. The machine scores
``sigmoid(b + sum w_i + 1/2 * sum_f ((sum v_if)^2 - sum v_if^2))`` over the buckets present, so pairs of terms count
together where neither does alone. It is learned on a bounded sample of labelled documents by stochastic gradient
descent with AdaGrad steps, over the terms whose presence goes with the label beyond chance, alone or in a pair whose
interaction does (``p11 - p10 - p01 + p00`` over the shares of label 1 with both, one or none of two terms); single weights get an
L1 and factor rows a group penalty. The many terms left out score nothing, which keeps long clean texts unharmed. Scoring is one narrow pass over whole texts.

Defined cases: null and empty texts have no terms and score ``sigmoid(b)``. Every row gives one row, repeated rows
and null ids included. Labels that are null, or whose document is missing, are ignored; of several labels of one
document the largest counts. Without both classes in the sample every score is the sample's share of label 1, or
0.5 without a sample. Extra columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample

#: Buckets, factors, and labelled documents of each class that are learned from at most.
BITS, FACTORS, SAMPLE = 18, 8, 2000
EPOCHS, RATE, L1, GROUP = 10, 0.1, 2e-3, 5e-3
#: A term is learned if that many documents of the sample hold it and its share of label 1 differs from the sample's by this squared z-score.
LEAST_DOCS, TELLING = 3, 14.0
#: Both terms of a pair are learned if the squared z-score of their interaction is that large, over cells of that many documents.
#: Pairs are far more than terms, so that chance reaches higher among them.
TELLING_PAIR, LEAST_CELL = 40.0, 5
PREFIXES = (4, 5, 6)
WORDS_KEPT = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def _buckets(word: str) -> list[int]:
    return [zlib.crc32(word.encode()) & (1 << BITS) - 1] + [zlib.crc32(word[:n].encode(), n) & (1 << BITS) - 1 for n in PREFIXES if len(word) >= n]


def terms(text: str | None) -> np.ndarray:
    """Distinct buckets of a text."""
    return np.unique(np.array([b for w in set(_WORD.findall((text or "").lower())) for b in _buckets(w)], np.int32))


@dataclass
class Machine:
    """Parameters of the buckets that are not zero: ``row`` maps a bucket to its row or to -1."""

    bias: float
    row: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def score(self, rows) -> float:
        rows = np.fromiter(rows, np.int64, len(rows))
        v = self.v[rows]
        total = v.sum(0)
        z = self.bias + self.w[rows].sum() + 0.5 * float((total * total - (v * v).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def telling_pairs(docs: list[np.ndarray], labels: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Buckets of the pairs whose interaction goes with the label.

    Pairs are counted from the documents that hold a term, so the work is that of pairs that do occur together.
    """
    share, n = labels.mean(), len(docs)
    # Of fewer documents with or without a term, one of its two cells is too small.
    terms = np.flatnonzero((seen >= 2 * LEAST_CELL) & (n - seen >= 2 * LEAST_CELL))
    row = np.full(len(seen), -1, np.int64)
    row[terms] = np.arange(len(terms))
    held = [r[r >= 0] for r in (row[d] for d in docs)]
    size, toxic = len(terms), labels > 0
    flat, owner = np.concatenate(held), np.repeat(np.arange(n), [len(x) for x in held])
    order = np.argsort(flat, kind="stable")
    n1, y1, y = np.bincount(flat, minlength=size), np.bincount(flat[toxic[owner]], minlength=size), int(toxic.sum())
    docs_of = np.split(owner[order], np.cumsum(n1)[:-1]) if size else []
    least = TELLING_PAIR * share * (1 - share)
    tells = np.zeros(size, bool)
    for a, mine in enumerate(docs_of):
        both = np.bincount(np.concatenate([held[d] for d in mine]), minlength=size)
        b = np.flatnonzero(both[a + 1 :] >= LEAST_CELL) + a + 1
        n11 = both[b]
        b = b[(n1[a] - n11 >= LEAST_CELL) & (n1[b] - n11 >= LEAST_CELL) & (n - n1[a] - n1[b] + n11 >= LEAST_CELL)]
        if not len(b):
            continue
        n11 = both[b]
        bad = [held[d] for d in mine if toxic[d]]
        y11 = np.bincount(np.concatenate(bad), minlength=size)[b] if bad else np.zeros(len(b), np.int64)
        n10, n01, y10, y01 = n1[a] - n11, n1[b] - n11, y1[a] - y11, y1[b] - y11
        n00, y00 = n - n11 - n10 - n01, y - y11 - y10 - y01
        found = (y11 / n11 - y10 / n10 - y01 / n01 + y00 / n00) ** 2 >= least * (1 / n11 + 1 / n10 + 1 / n01 + 1 / n00)
        tells[a] |= found.any()
        tells[b[found]] = True
    return terms[tells]


def learn(docs: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Machine:
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Machine(float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.full(size, -1, np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    seen = np.bincount(np.concatenate(docs), minlength=size)
    toxic = np.bincount(np.concatenate([d for d, y in zip(docs, labels, strict=True) if y]), minlength=size)
    share = labels.mean()
    chance = np.maximum(seen * share * (1 - share) * (1 - seen / len(docs)), 1e-9)
    used = np.flatnonzero((seen >= LEAST_DOCS) & ((toxic - seen * share) ** 2 >= TELLING * chance))
    used = np.union1d(used, telling_pairs(docs, labels, seen))
    row = np.full(size, -1, np.int32)
    row[used] = np.arange(len(used))
    docs = [r[r >= 0] for r in (row[d] for d in docs)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(used)), rng.normal(0, 0.01, (len(used), FACTORS))
    gw, gv, bias, gb = np.full(len(used), 1e-6), np.full((len(used), FACTORS), 1e-6), 0.0, 1e-6
    for _ in range(EPOCHS):
        for d in rng.permutation(len(docs)):
            i = docs[d]
            x = v[i]
            total = x.sum(0)
            z = bias + w[i].sum() + 0.5 * ((total * total).sum() - (x * x).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[d]
            gb += g * g
            bias -= RATE * g / np.sqrt(gb)
            if abs(g) < 1e-4:
                continue
            gw[i] += g * g
            step = RATE / np.sqrt(gw[i])
            new = w[i] - step * g
            w[i] = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
            grad = g * (total - x)
            gv[i] += grad * grad
            x = x - RATE * grad / np.sqrt(gv[i])
            norm = np.sqrt((x * x).sum(1))
            v[i] = x * np.maximum(1 - RATE * GROUP / np.maximum(norm, 1e-12), 0)[:, None]
    small = np.abs(w) < 1e-3
    quiet = np.sqrt((v * v).sum(1)) < 5e-2
    w[small], v[quiet] = 0, 0
    kept = np.flatnonzero(~(small & quiet))
    out = np.full(size, -1, np.int32)
    out[used[kept]] = np.arange(len(kept))
    return Machine(float(bias), out, w[kept], v[kept])


class _Rows(dict):
    """Word -> rows of its buckets that are not zero; bounded."""

    def __init__(self, row: np.ndarray):
        super().__init__()
        self.row = row

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = tuple(r for r in self.row[_buckets(word)].tolist() if r >= 0)
        return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Learns from the labelled rows that are not held out: at most ``SAMPLE`` documents a class, as buckets, in one task."""
    sample = labelled_sample(docs, labels, label, SAMPLE, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "label", "terms"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, arrow_schema).sort_by("doc_id")
        m = learn([x.values.to_numpy() for x in rows["terms"]], rows["label"].to_numpy().astype(float))
        used = np.flatnonzero(m.row >= 0)
        cells = [pa.array([x.tobytes()], pa.binary()) for x in (used.astype(np.int64), m.w[m.row[used]].astype(float), m.v[m.row[used]].astype(float))]
        yield pa.RecordBatch.from_arrays([*cells, pa.array([m.bias], pa.float64())], names=["used", "w", "v", "bias"])

    arrow_schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.int32()))])
    found = sample.mapInArrow(run, "doc_id long, label int, terms array<int>")
    m = found.repartition(1).mapInArrow(train, "used binary, w binary, v binary, bias double").first()
    used, row = np.frombuffer(m.used, np.int64), np.full(1 << BITS, -1, np.int32)
    row[used] = np.arange(len(used))
    return Machine(m.bias, row, np.frombuffer(m.w), np.frombuffer(m.v).reshape(-1, FACTORS))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, score``. The machine's size is bounded by ``BITS``."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        rows = _Rows(m.row)
        for batch in batches:
            scores = []
            for text in batch.column(1):
                words = set(_WORD.findall((text.as_py() or "").lower()))
                scores.append(m.score({r for found in map(rows.__getitem__, words) for r in found}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
