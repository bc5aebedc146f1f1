"""Benchmark decontamination with suffix arrays over shards of the training documents.

Words are runs of ``[0-9a-z]`` and of characters beyond ASCII, after A-Z are lower-cased. A task cuts its
documents into shards of bounded size. In a shard, words that no benchmark item holds end every match, so only
runs of known words that are long enough for a window enter the suffix array (prefix doubling in numpy). Every
distinct window with which a suffix of an item begins is binary-searched in it; windows of one length have ranges that
don't overlap, so what is found never exceeds the shard. Nothing is shuffled: a document stays in its task.

Which items occur is told from distinct windows and distinct item texts, in parts of bounded size; for each of them the
longest stretch that item and document share word for word is found by bisection over its length (hashes of window
runs, compared word by word before they count). So a document has one match an item, however often it repeats.

The benchmark is the query set. It is cut into pieces of ``PIECE_WORDS`` words (overlapping, so that no window is lost) and
handed out in blocks of about ``BLOCK_WORDS`` words, one after the other: a block is broadcast, all documents are compared
with it, the rows with what they matched are written to the shared folder, and the block is dropped before the next one
is read. So a large benchmark, or a large item, costs more passes and never more memory. A single block needs no writing.

Defined cases: null and wordless texts have no words and no matches. Items without words or with a null id match
nothing; equal items all match. Of equally long stretches the first in the document, then in the item counts. Every row of ``docs`` gives one row with the matches of its
own text, whatever the number of blocks: repeated rows, repeated ids and null ids included. Very long texts are searched
whole; a match with an item of more than ``PIECE_WORDS`` words ends where the item was cut. Extra columns are ignored by
``contamination`` and stay in ``decontaminated``; empty tables give no matches or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, store

WINDOW = 10
#: Words of the benchmark that one broadcast holds, and words of documents that one suffix array covers.
BLOCK_WORDS, SHARD_WORDS = 1_000_000, 1_000_000
#: Words of an item that stay together, and pairs of a document and an item that are told apart at once.
PIECE_WORDS, PAIRS = 1 << 16, 1 << 20

#: Bytes: A-Z to a-z, digits, a-z and all beyond ASCII as they are, all others to a blank.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: The words that ``words_of`` finds, as a pattern.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ROOT, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_MATCH = {"item_id": pa.int64(), "item_start": pa.int32(), "doc_start": pa.int32(), "length": pa.int32()}
_SPAN = {"start": pa.int32(), "end": pa.int32()}
_ROW_DDL = "doc_id long, text string, n_words long, hits array<struct<start:int,end:int>>, matches array<struct<item_id:long,item_start:int,doc_start:int,length:int>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...`` of each size, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


class Lists:
    """Many lists of numbers in one array: list ``k`` is ``values[start[k] : start[k + 1]]``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, count: int):
        order = np.lexsort((values, keys))
        self.values, self.start = values[order], np.searchsorted(keys[order], np.arange(count + 1))

    def of(self, k: int) -> np.ndarray:
        return self.values[self.start[k] : self.start[k + 1]]

    def all_of(self, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all lists ``ks``, and how many each has."""
        sizes = self.start[ks + 1] - self.start[ks]
        return self.values[_ranges(self.start[ks], sizes)], sizes


class Probe:
    """The distinct windows of a block of items, as word numbers (1 and up; 0 is any other word), and who holds them.

    ``items`` are ``(item_id, offset of the piece, text)``. Equal pieces are one text with several items.
    """

    def __init__(self, items: list[tuple[int, int, str | None]], window: int):
        self.number: dict[bytes, int] = {}
        self.window = window
        held: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, offset, text in sorted(items, key=lambda i: i[:2]):
            words = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words_of(text))
            if words:
                held.setdefault(words, []).append((item, offset))
        texts = [np.array(t, np.int32) for t in held]
        #: Items and offsets of each text.
        self.named = list(held.values())
        self.words, self.length, text_of, at_of, window_of = np.zeros((0, window), np.int32), np.zeros(0, np.int64), [], [], []
        for n in range(1, window + 1):
            some = [t for t, x in enumerate(texts) if min(len(x), window) == n]
            if not some:
                continue
            cut = np.concatenate([np.lib.stride_tricks.sliding_window_view(texts[t], n) for t in some])
            rows, which = np.unique(cut, axis=0, return_inverse=True)
            window_of.append(which.ravel() + len(self.words))
            self.words = np.concatenate([self.words, np.pad(rows, ((0, 0), (0, window - n)))])
            self.length = np.r_[self.length, np.full(len(rows), n)]
            sizes = np.array([len(texts[t]) - n + 1 for t in some])
            text_of.append(np.repeat(some, sizes))
            at_of.append(_ranges(np.zeros(len(some), np.int64), sizes))
        if not texts:
            text_of = at_of = window_of = [np.zeros(0, np.int64)]
        text, at, win = map(np.concatenate, (text_of, at_of, window_of))
        order = np.lexsort((at, text))
        #: The windows of every text in order: those of text ``t`` are ``chain[of[t] : of[t + 1]]``.
        self.chain, self.of = win[order], np.searchsorted(text[order], np.arange(len(texts) + 1))
        pairs = np.unique(np.stack([win, text]), axis=1) if len(win) else np.zeros((2, 0), np.int64)
        self.texts = Lists(*pairs, len(self.length))
        self.least = int(self.length.min()) if len(self.length) else 0


def known_runs(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of nonzero numbers that are at least ``least`` long, each followed by a 0, and where each stood."""
    inside = np.diff(np.r_[False, words > 0, False].astype(np.int8))
    starts, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    long = ends - starts >= least
    starts, sizes = starts[long], (ends - starts)[long] + 1
    if not len(starts):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    at = np.arange(sizes.sum()) + np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
    out = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)
    out[np.cumsum(sizes) - 1] = 0
    return out.astype(np.int32), at


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of nonzero words in the order of their suffixes, compared over ``depth`` words at least; 0 ends a suffix."""
    rank, k = words.astype(np.int64), 1
    while k < depth:
        ahead = np.zeros_like(rank)
        ahead[:-k] = rank[k:]
        ahead[words == 0] = 0
        _, rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)
        rank = np.where(words == 0, 0, rank + 1)
        k *= 2
    order = np.argsort(rank, kind="stable")
    return order[np.searchsorted(rank[order], 1) :]


def search(words: np.ndarray, order: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """For every distinct window the range of ``order`` whose suffixes begin with it."""
    padded = np.r_[words, np.zeros(probe.window, np.int32)]

    def bound(after: bool) -> np.ndarray:
        lo, hi = np.zeros(len(probe.length), np.int64), np.full(len(probe.length), len(order))
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, len(order) - 1)]
            sign = np.zeros(len(mid), np.int64)
            for t in range(probe.window):
                part = (sign == 0) & (t < probe.length)
                sign[part] = np.sign(padded[at[part] + t].astype(np.int64) - probe.words[part, t])
            right = open_ & ((sign < 0) | (after & (sign == 0)))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo

    return bound(False), bound(True)


def starts(words: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of items stand in ``words``: positions and windows, at most one of each length at a position."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not probe.least:
        return none
    short, at = known_runs(words, probe.least)
    if not len(short):
        return none
    order = suffix_array(short, probe.window)
    lo, hi = search(short, order, probe)
    found = np.flatnonzero(hi > lo)
    return at[order[_ranges(lo[found], hi[found] - lo[found])]], np.repeat(found, hi[found] - lo[found])


def _runs(x: np.ndarray, n: int, top: int) -> np.ndarray:
    """A hash of every ``n`` consecutive numbers; comparable between arrays of at most ``top`` numbers."""
    powers = np.cumprod(np.r_[np.uint64(1), np.full(top, _ROOT, np.uint64)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum((x.astype(np.uint64) + np.uint64(2)) * _STEP * powers[: len(x)], dtype=np.uint64)]
    return (sums[n:] - sums[:-n]) * powers[top - n - np.arange(len(x) - n + 1)]


def _shared(doc: np.ndarray, text: np.ndarray, n: int) -> tuple[int, int] | None:
    """The first place of ``doc``, and of ``text`` for it, where both hold the same ``n`` numbers."""
    top = max(len(doc), len(text))
    ours, theirs = _runs(doc, n, top), _runs(text, n, top)
    values, place = np.unique(theirs, return_index=True)
    at = np.minimum(np.searchsorted(values, ours), len(values) - 1)
    for i in np.flatnonzero(values[at] == ours).tolist():
        j = int(place[at[i]])
        if (doc[i : i + n] == text[j : j + n]).all():
            return i, j
    return None


def longest(position: np.ndarray, window: np.ndarray, text: int, probe: Probe) -> tuple[int, int, int]:
    """(position, offset, words) of the longest stretch that a text shares with a document's windows, sorted by window and place."""
    chain = probe.chain[probe.of[text] : probe.of[text + 1]]
    held = np.unique(chain)
    lo, hi = np.searchsorted(window, held), np.searchsorted(window, held, side="right")
    own = _ranges(lo, hi - lo)
    own = own[np.argsort(position[own], kind="stable")]
    gap = np.flatnonzero(np.diff(position[own]) != 1) + 1
    doc, at = np.insert(window[own], gap, -1), np.insert(position[own], gap, 0)
    lo, hi, best = 1, min(len(chain), int(np.diff(np.r_[0, gap, len(own)]).max())), None
    while lo <= hi:
        n = (lo + hi) // 2
        found = _shared(doc, chain, n)
        if found:
            best, lo = (int(at[found[0]]), found[1], n + int(probe.length[chain[0]]) - 1), n + 1
        else:
            hi = n - 1
    return best


def _better(match: tuple) -> tuple:
    """Of the matches of one item the smallest of these stays."""
    item, offset, start, n = match
    return -n, start, offset


def _items_of(doc: np.ndarray, window: np.ndarray, probe: Probe) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs of a document and a text with a window in it, in parts of about ``PAIRS``."""
    pairs = np.unique(np.stack([doc, window]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
    doc, window = pairs
    sizes = np.cumsum(probe.texts.start[window + 1] - probe.texts.start[window])
    seen = np.zeros((2, 0), np.int64)
    for part in np.split(np.arange(len(doc)), np.searchsorted(sizes, np.arange(PAIRS, int(sizes[-1]) if len(sizes) else 0, PAIRS))):
        texts, n = probe.texts.all_of(window[part])
        now = np.unique(np.stack([np.repeat(doc[part], n), texts]), axis=1)
        # Documents come in order, so only the last one of a part goes on in the next.
        if now.size and seen.size:
            now = np.unique(np.concatenate([seen, now], axis=1), axis=1)
        last = now[0] == (now[0, -1] if now.size else -1)
        yield now[0][~last], now[1][~last]
        seen = now[:, last]
    yield seen[0], seen[1]


def _searched(probe, more: bool) -> object:
    """Rows (doc_id, text, n_words, hits, matches) to the same with what one more block adds; texts go on if ``more`` follow."""

    def shard(rows: list, numbers: list, p: Probe) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in numbers], np.int64)
        first = np.cumsum(sizes + 1) - (sizes + 1)
        position, window = starts(np.concatenate([np.r_[x, np.zeros(1, np.int32)] for x in numbers]), p)
        row_of = lambda at: np.searchsorted(first, at, side="right") - 1
        hit = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int64)
        np.add.at(hit, position, 1)
        np.add.at(hit, position + p.length[window], -1)
        found: list[dict] = [{m["item_id"]: tuple(m[c] for c in _MATCH) for m in held or ()} for _, _, _, held in rows]
        for row, (_, _, held, _) in enumerate(rows):
            for span in held or ():
                hit[first[row] + span["start"]] += 1
                hit[first[row] + span["end"]] -= 1
        doc = row_of(position)
        order = np.lexsort((position, window, doc))
        doc, position, window = doc[order], position[order], window[order]
        for docs, texts in _items_of(doc, window, p):
            for d, text in zip(docs.tolist(), texts.tolist(), strict=True):
                own = slice(*np.searchsorted(doc, [d, d + 1]))
                at, offset, n = longest(position[own], window[own], text, p)
                for item, piece in p.named[text]:
                    match = (item, piece + offset, at - int(first[d]), n)
                    found[d][item] = min(match, found[d].get(item, match), key=_better)
        edge = np.diff(np.r_[0, np.cumsum(hit) > 0].astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hits: list[list] = [[] for _ in rows]
        for row, b, e in zip(row_of(begin).tolist(), begin.tolist(), end.tolist(), strict=True):
            hits[row].append((b - int(first[row]), e - int(first[row])))
        spans = lambda lists, types: pa.array([[dict(zip(types, x, strict=True)) for x in xs] for xs in lists], pa.list_(pa.struct(list(types.items()))))
        told = [sorted(x.values(), key=lambda m: (m[2], m[0])) for x in found]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] if more else None for r in rows], pa.string()), pa.array(sizes), spans(hits, _SPAN), spans(told, _MATCH)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_words", "hits", "matches"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = probe.value
        number, rows, numbers, size = p.number.get, [], [], 0
        for batch in batches:
            key, text, held = batch.column(0).to_pylist(), batch.column(1), [batch.column(c) for c in ("hits", "matches")]
            for k in range(batch.num_rows):
                words = words_of(said := text[k].as_py())
                rows.append((key[k], said, *(c[k].as_py() for c in held)))
                numbers.append(np.fromiter(map(number, words, repeat(0)), np.int32, len(words)))
                size += len(words) + 1
                if size >= SHARD_WORDS:
                    yield shard(rows, numbers, p)
                    rows, numbers, size = [], [], 0
        if rows:
            yield shard(rows, numbers, p)

    return run


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``item_id, at, text``: items cut into pieces of ``PIECE_WORDS`` words that share a window but one word."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), words.alias("words")).where("item_id is not null and size(words) > 0")
    at = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(PIECE_WORDS))
    cut = items.select("item_id", "words", F.explode(at).alias("at"))
    return cut.select("item_id", "at", F.slice("words", F.col("at") + 1, F.lit(PIECE_WORDS + window - 1)).alias("words"))


def _by_blocks(rows: DataFrame, items: DataFrame, window: int, step) -> DataFrame:
    """``step(rows, block, more)`` for each block of the benchmark; with several, what a step returns is written and reread."""
    spark = rows.sparkSession
    pieces = _pieces(items, window)
    blocks = int(-(-(pieces.agg(F.sum(F.size("words"))).first()[0] or 0) // BLOCK_WORDS)) or 1
    pieces = pieces.select("item_id", "at", F.array_join("words", " ").alias("text")).withColumn("block", F.pmod(F.xxhash64("item_id", "at", "text"), F.lit(blocks)))
    schema, before = rows.schema, None
    for b in range(blocks):
        block = spark.sparkContext.broadcast(Probe([tuple(r) for r in pieces.where(F.col("block") == b).select("item_id", "at", "text").collect()], window))
        rows = step(rows, block, b + 1 < blocks)
        if blocks > 1:
            path = store(rows, "matched")
            block.destroy()
            if before:
                forget(spark, before)
            rows, before = spark.read.schema(schema).parquet(path), path
    return rows


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, n_words, n_hit, items, matches`` of each document against ``items(item_id, text)``.

    ``n_hit`` counts the words inside any window of an item, ``items`` are the ids with such a window (sorted as strings),
    ``matches`` the longest verbatim stretch of each of them, sorted by its place in the document, then by item.
    """
    empty = {"hits": "array<struct<start:int,end:int>>", "matches": _ROW_DDL.rpartition(", matches ")[2]}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), *[F.array().cast(t).alias(n) for n, t in empty.items()])
    found = _by_blocks(rows, items, window, lambda df, block, more: df.mapInArrow(_searched(block, more), _ROW_DDL))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["start"])
    items_met = F.array_sort(F.transform("matches", lambda m: m["item_id"].cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), items_met.alias("items"), "matches")


def _clean(probe, text_at: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = probe.value
        for batch in batches:
            keep, numbers, held = np.ones(batch.num_rows, bool), [], 0
            first = 0
            for row, text in enumerate(batch.column(text_at)):
                words = words_of(text.as_py())
                numbers.append(np.r_[np.fromiter(map(p.number.get, words, repeat(0)), np.int32, len(words)), np.zeros(1, np.int32)])
                held += len(words) + 1
                if held >= SHARD_WORDS or row == batch.num_rows - 1:
                    begin = np.cumsum([0, *map(len, numbers)])[:-1]
                    keep[first + np.searchsorted(begin, starts(np.concatenate(numbers), p)[0], side="right") - 1] = False
                    first, numbers, held = row + 1, [], 0
            yield batch.filter(pa.array(keep))

    return run


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of any item. Rows are dropped where they are read: no shuffle."""
    at = docs.columns.index(text_col)
    return _by_blocks(docs, items, window, lambda df, block, _: df.mapInArrow(_clean(block, at), docs.schema))
