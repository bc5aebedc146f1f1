"""Quality classifier with supervised subword embeddings.

Every word, every pair of neighbouring words and every character 3- to 5-gram of a word (with its bounds, case kept)
is hashed to a bucket with a learned vector. With ``again`` (the default) all pairs of a word with itself share a bucket
of their own, whatever the word: hashing alone has no unit for "a word that repeats", and the README has the figures of
both ways. A document is the average of its units' vectors; a softmax layer on top
gives the class. Vectors and layer are learned by stochastic gradient descent in numpy on a bounded sample of labelled
documents, in one task of bounded size. As the layer is linear, scoring needs one number a bucket; texts are cut into
code points and all units of many documents are hashed at once.

Defined cases: null and empty texts have no units and score by the bias alone. A text longer than ``PIECE`` is read
piece by piece; open words, the last word and the last code points go along, so its units are those of the whole text.
Every row gives one row, repeated rows and null ids included. Labels that are null, or whose document is missing, are
ignored; of several labels of a document the largest counts, of several texts the one with the smallest digest. Without both classes in the sample every score is the
sample's share of label 1, or 0.5 without a sample. Extra columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample

#: Buckets, vector size, and labelled documents of each class that are learned from at most.
BITS, SIZE, SAMPLE = 18, 16, 600
EPOCHS, RATE = 12, 40.0
GRAMS = (3, 4, 5)
#: Code points that are hashed at once.
PIECE = 1 << 18
#: A document that scores less is rejected.
LEAST = 0.3

_BLANK = 32
_ROOT = 0x9E3779B97F4A7C15
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bucket of a word that follows itself.
_AGAIN = (1 << BITS) - 1


class Model(NamedTuple):
    """A number for each bucket, the bias, and whether repeated words have their own unit."""

    value: np.ndarray
    bias: float
    again: bool = True


def _pairs(h: np.ndarray, again: bool) -> np.ndarray:
    """Buckets of neighbouring words."""
    hashed = _bucket(h[:-1] * _PAIR + h[1:])
    return np.where(h[:-1] == h[1:], _AGAIN, hashed) if again else hashed


def _powers(of: int, count: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(count, of, np.uint64)], dtype=np.uint64)


#: Powers of the root and of its inverse, for texts of up to ``2 * PIECE`` code points and their blanks.
_POWERS, _INVERSES = _powers(_ROOT, 2 * PIECE + 64), _powers(pow(_ROOT, -1, 1 << 64), 2 * PIECE + 64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, every ASCII white space a blank, and which are blanks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    blank = (points == _BLANK) | ((points >= 9) & (points <= 13))
    return np.where(blank, np.uint64(_BLANK), points), blank


def _grams(points: np.ndarray, blank: np.ndarray, known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, starts) of the n-grams without an inner blank that end behind the first ``known`` points."""
    before = np.cumsum(blank)
    for n in GRAMS:
        lo, size = max(0, known - n + 1), len(points) - n + 1
        if size <= lo:
            continue
        at = np.arange(lo, size)
        at = at[before[at + n - 2] == before[at]]
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(_ROOT) + points[at + j]
        yield h, at


def _word_hashes(points: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words: runs of points that are not blank."""
    edge = np.diff(np.r_[True, blank, True].astype(np.int8))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.r_[np.uint64(0), np.cumsum(points * _POWERS[: len(points)], dtype=np.uint64)]
    return first, end, (sums[end] - sums[first]) * _INVERSES[first]


def units(texts: list[str], again: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (buckets, number of the text that each belongs to) for texts of ``2 * PIECE`` code points at most in all."""
    points, blank = _points(" " + " ".join(texts) + " ")
    starts = np.cumsum(np.array([0, *(len(t) + 1 for t in texts)]))[:-1]
    owner = np.repeat(np.arange(len(texts)), np.diff(np.r_[starts, len(points)]))
    for h, at in _grams(points, blank):
        yield _bucket(h), owner[at]
    first, _, h = _word_hashes(points, blank)
    of = owner[first]
    yield _bucket(h), of
    pair = of[1:] == of[:-1]
    yield _pairs(h, again)[pair], of[1:][pair]


def long_units(text: str, again: bool = True) -> Iterator[np.ndarray]:
    """Buckets of one text, read in pieces; in all the same as those of ``units``."""
    behind, behind_blank = _points(" ")
    word, size = np.uint64(0), 0  # hash and length of a word that the end of a piece cut
    last: list[np.uint64] = []
    for lo in range(0, len(text), PIECE):
        points, blank = _points(text[lo : lo + PIECE] + " " * (lo + PIECE >= len(text)))
        wide, wide_blank = np.r_[behind, points], np.r_[behind_blank, blank]
        for h, _ in _grams(wide, wide_blank, len(behind)):
            yield _bucket(h)
        behind, behind_blank = wide[1 - GRAMS[-1] :], wide_blank[1 - GRAMS[-1] :]
        first, end, h = _word_hashes(points, blank)
        with np.errstate(over="ignore"):
            if size and len(first) and first[0] == 0:
                h[0] = word + np.uint64(pow(_ROOT, size, 1 << 64)) * h[0]
                first[0] = -size
            elif size:
                h, first, end = np.r_[word, h], np.r_[-size, first], np.r_[0, end]
        word, size = np.uint64(0), 0
        if len(end) and end[-1] == len(points) and not blank[-1]:
            word, size = h[-1], int(end[-1] - first[-1])
            h = h[:-1]
        yield _bucket(h)
        h = np.r_[np.array(last, np.uint64), h]
        yield _pairs(h, again)
        last = list(h[-1:])


def bag(text: str | None, again: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    text = text or ""
    found = [b for b, _ in units([text], again)] if len(text) <= PIECE else list(long_units(text, again))
    return np.unique(np.concatenate(found), return_counts=True)


def learn(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """-> (a number for each bucket, bias): the log odds of label 1 are their average plus the bias."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return np.zeros(size, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (size, SIZE)).astype(np.float32)
    layer, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    shares = [(b, (c / c.sum()).astype(np.float32)) for b, c in bags]
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for d in rng.permutation(len(bags)):
            rate = 1 - done / steps
            done += 1
            i, share = shares[d]
            if not len(i):
                continue
            mean = share @ vectors[i]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[d])] -= 1
            back = p @ layer
            layer -= rate * 0.5 * np.outer(p, mean)
            bias -= rate * 0.01 * p
            vectors[i] -= rate * RATE * share[:, None] * back[None, :]
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", again: bool = True) -> Model:
    """Learns from labelled rows that are not held out: at most ``SAMPLE`` documents a class, as bags, in one task."""
    sample = labelled_sample(docs, labels, label, SAMPLE, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag(t.as_py(), again) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([b[k].astype(np.int32) for b in bags], pa.list_(pa.int32())) for k in (0, 1))], names=["doc_id", "label", "buckets", "counts"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, arrow_schema).sort_by("doc_id")
        bags = [(b.values.to_numpy(), c.values.to_numpy()) for b, c in zip(rows["buckets"], rows["counts"], strict=True)]
        value, bias = learn(bags, rows["label"].to_numpy().astype(int))
        yield pa.RecordBatch.from_arrays([pa.array([value.astype(np.float32).tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["value", "bias"])

    arrow_schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
    bags = sample.mapInArrow(run, "doc_id long, label int, buckets array<int>, counts array<int>")
    model = bags.repartition(1).mapInArrow(train, "value binary, bias double").first()
    return Model(np.frombuffer(model.value, np.float32), model.bias, again)


def _scores(column: pa.Array, value: np.ndarray, bias: float, again: bool = True) -> np.ndarray:
    total, count = np.zeros(len(column)), np.zeros(len(column))
    rows: list[int] = []
    held: list[str] = []
    size = 0

    def flush() -> None:
        at = np.array(rows)
        for buckets, owner in units(held, again):
            total[at] += np.bincount(owner, value[buckets], len(held))
            count[at] += np.bincount(owner, minlength=len(held))

    for row, text in enumerate(column):
        text = text.as_py() or ""
        if len(text) > PIECE:
            for buckets in long_units(text, again):
                total[row] += value[buckets].sum(dtype=np.float64)
                count[row] += len(buckets)
            continue
        rows.append(row)
        held.append(text)
        size += len(text) + 1
        if size >= PIECE:
            flush()
            rows, held, size = [], [], 0
    if held:
        flush()
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, score``. The model is one float a bucket."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), *held.value))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score less than ``least``; rows are dropped where they are read."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), *held.value) >= least))

    return docs.mapInArrow(run, docs.schema)
