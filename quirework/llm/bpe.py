"""Byte-level BPE encoding and decoding with a public vocabulary file.

Encoding splits a text into pieces by the vocabulary's pattern and merges each piece on its own: a priority queue
of merge ranks runs over a doubly linked list of symbols; queue entries whose symbols have changed meanwhile are
stale and skipped. Decoding concatenates the byte strings of the vocabulary. Special tokens that stand in a text
become their own id, as the vocabulary's library does by default. A worker remembers the ids of pieces it has met;
the ids of a batch, and their byte strings, are then gathered from tables at once.

Defined cases: null and empty texts give an empty id list, which decodes to an empty text. Very long texts and pieces
are encoded whole. Every row gives one row, repeated rows and null ids included. Extra columns are left out of the
result. An empty table stays empty.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The split pattern of the vocabulary (fixed value of the public byte-level BPE format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters alone, which the plain engine matches faster.
ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Pieces, and ids of pieces, that a worker remembers from one batch to the next.
PIECES_KEPT, IDS_KEPT = 400_000, 4_000_000
#: Characters of the texts that are encoded at once, but for a single longer one.
BATCH_CHARS = 4_000_000


def _byte_letters() -> dict[str, int]:
    """The format writes each byte as a printable letter: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return letters


def _gathered(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``which`` of lists that lie one after the other in ``flat``, and their ends."""
    starts, many = (np.cumsum(sizes) - sizes)[which], sizes[which]
    ends = np.cumsum(many)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - many), many)], ends


class _Pieces(dict):
    """Piece -> its number. The ids of all pieces lie one after the other; a special token is a tuple of its text."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.ids, self.sizes = bpe, array("i"), array("q")

    def __missing__(self, piece: str | tuple) -> int:
        ids = [self.bpe.special[piece[0]]] if isinstance(piece, tuple) else self.bpe.merged(piece.encode("utf-8", "surrogatepass"))
        number = self[piece] = len(self.sizes)
        self.ids.extend(ids)
        self.sizes.append(len(ids))
        return number

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = _gathered(np.array(self.ids, np.int32), np.array(self.sizes, np.int64), numbers)
        if len(self) > PIECES_KEPT or len(self.ids) > IDS_KEPT:
            self.clear()
            self.ids, self.sizes = array("i"), array("q")
        return out


class Bpe:
    def __init__(self, source: str):
        spec = json.loads(source)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        strings = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if s not in self.special}
        strings.update({i: s.encode() for s, i in self.special.items()})
        self.known_ids = np.zeros(max(strings) + 1, bool)
        self.known_ids[list(strings)] = True
        self.bytes = np.frombuffer(b"".join(strings.get(i, b"") for i in range(len(self.known_ids))), np.uint8)
        self.bytes_of = np.array([len(strings.get(i, b"")) for i in range(len(self.known_ids))], np.int64)
        self.of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.pattern, self.ascii = regex.compile(PATTERN), re.compile(ASCII, re.ASCII)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = _Pieces(self)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := self.merges.get((ids[i], ids[i + 1])))]
        queue = [(rank, i, new, a, b) for rank, new, i, a, b in queue]
        heapq.heapify(queue)
        while queue:
            _, i, new, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # stale
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (found[0], left, found[1], ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def _numbers(self, text: str) -> np.ndarray:
        pieces = (self.ascii if text.isascii() else self.pattern).findall(text)
        return np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids end."""
        numbers = []
        for text in texts:
            if any(s in text for s in self.special):
                parts = [np.array([self.pieces[(p,)]], np.int64) if p in self.special else self._numbers(p) for p in self.cut.split(text)]
                numbers.append(np.concatenate(parts))
            else:
                numbers.append(self._numbers(text))
        ids, ends = self.pieces.gathered(np.concatenate(numbers) if numbers else np.empty(0, np.int64))
        return ids, np.r_[0, ends][np.cumsum([len(x) for x in numbers], dtype=np.int64)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of lists of ids that lie one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known_ids) or not self.known_ids[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        raw, upto = _gathered(self.bytes, self.bytes_of, ids)
        raw, cuts = raw.tobytes(), np.r_[0, np.r_[0, upto][ends]].tolist()
        return [raw[lo:hi].decode("utf-8", "replace") for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]

    def decode(self, ids) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]


_LOADED: dict[int, Bpe] = {}


def _loaded(source) -> Bpe:
    """One vocabulary a worker process."""
    if source.id not in _LOADED:
        _LOADED.clear()
        _LOADED[source.id] = Bpe(source.value)
    return _LOADED[source.id]


class _Source:
    """The vocabulary file's text, broadcast once (about 1.5 MB; its size does not depend on the data)."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            held = spark.sparkContext.broadcast(f.read())
        self.held, self.id = held, held._jbroadcast.id() if hasattr(held, "_jbroadcast") else id(held)

    def __getstate__(self):
        return {"held": self.held, "id": self.id}

    @property
    def value(self) -> str:
        return self.held.value


def _encoded(source, back: bool):
    def batch_of(bpe: Bpe, keys: list, texts: list[str]) -> pa.RecordBatch:
        ids, ends = bpe.encode_all(texts)
        columns = [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()))]
        if back:
            columns.append(pa.array(bpe.decode_all(ids, ends), pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(source)
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BATCH_CHARS:
                    yield batch_of(bpe, keys, texts)
                    keys, texts, size = [], [], 0
        if keys:
            yield batch_of(bpe, keys, texts)

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, ids array<int>`` for each row."""
    source = _Source(docs.sparkSession, path)
    return _texts(docs, id_col, text_col).mapInArrow(_encoded(source, False), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, ids, text``: ``encode`` and ``decode`` in one pass; the text is the one that the ids decode to."""
    source = _Source(docs.sparkSession, path)
    return _texts(docs, id_col, text_col).mapInArrow(_encoded(source, True), "doc_id long, ids array<int>, text string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, ids, text``; ids outside the vocabulary raise, null lists are empty texts."""
    source = _Source(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(source)
        for batch in batches:
            lists = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0, np.int64) for x in batch.column(1)]
            texts = bpe.decode_all(np.concatenate(lists) if lists else np.empty(0, np.int64), np.cumsum([len(x) for x in lists], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
