"""Substring deduplication by hashes of lines and of the sentences inside them.

A unit is a line, or a sentence of a longer line, of at least ``least`` words (``LEAST_WORDS``; 1 takes every line and
sentence). ``repeated_passages`` adds runs: from every shorter line or sentence on, and back from it, neighbours are
joined until the run has that many words, over line ends too. Where a script has no blanks, characters count in place
of words. A unit is normalised (Unicode NFC, lower case, single blanks) and hashed to 128 bits. Units with equal
digests anywhere in the table are one passage: its occurrence with the smallest document id, and there the first,
stays; all others are removed, but for runs that overlap it. Every line and sentence so stays at one place at least.
Spans keep their offsets in the original text.

A task sends the first occurrence of each digest it met, packed by hash range, so that a digest that stands everywhere
reaches its range once a batch; the number of ranges follows from the size of all texts. A range finds the digests that
repeat and the occurrence that stays. A task's other occurrences of a digest travel as one list, are joined with these
by digest, and dealt by batch and digest before the list becomes rows: one line that stands everywhere is one row a
batch, never a task's whole load. No text is shuffled to find repeats.

Defined cases: null and empty texts have no units. Very long texts and lines are read whole. Rows with a null ``doc_id``
are left as they are and do not count. Rows that repeat a document id at the same offsets do not count as repeats of
each other. Extra columns, whatever their names, stay in ``remove_repeats``. An empty table gives no spans.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep

LEAST_WORDS = 8
#: Units that a task packs before it sends them out; characters of all texts for each hash range, and ranges at least.
PACK_UNITS, RANGE_CHARS, LEAST_RANGES = 250_000, 32 << 20, 512

_LINE = re.compile(r"[^\n]+")
_BREAK = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？｡])(?![。！？｡”’」』）]|$)\s*")
#: Runs may begin after ``!`` and ``?`` without a blank, too.
_FINE = re.compile(_BREAK.pattern + r"|(?<=[!?])(?![!?.\s\"')\]]|$)")
#: Scripts without blanks, and how many of their characters count as a word.
_SCRIPTS = ((re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"), 2), (re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]"), 4))
def _words(text: str) -> list[str]:
    return unicodedata.normalize("NFC", text).lower().split()


def _size(words: list[str]) -> int:
    """Number of words; of scripts without blanks, characters by what counts as a word."""
    text = " ".join(words)
    if text.isascii():
        return len(words)
    size = 0
    for script, many in _SCRIPTS:
        text, found = script.subn(" ", text)
        size += found // many
    return size + len(text.split())


def _digest(words: str) -> bytes:
    return blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _pieces(line: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    cuts = [m.span() for m in pattern.finditer(line)]
    return zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(line)], strict=True)


def units(text: str, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(start, end, start of the line, words, digest); a line comes before its sentences."""
    for found in _LINE.finditer(text):
        line = found[0]
        words = _words(line)
        size = _size(words)
        if size < least:
            continue
        base = found.start()
        yield base, found.end(), base, size, _digest(" ".join(words))
        if not _BREAK.search(line):
            continue
        for lo, hi in _pieces(line, _BREAK):
            if hi - lo < 2 * least - 1:
                continue
            words = _words(line[lo:hi])
            size = _size(words)
            if size >= least:
                yield base + lo, base + hi, base, size, _digest(" ".join(words))


def runs(text: str, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Like ``units``: the shortest runs of neighbouring pieces that begin or end with a short one and are long enough."""
    pieces = []
    for found in _LINE.finditer(text):
        base = found.start()
        for lo, hi in _pieces(found[0], _FINE):
            if words := _words(found[0][lo:hi]):
                pieces.append((base + lo, base + hi, base, _size(words), " ".join(words)))
    seen = set()
    for k, piece in enumerate(pieces):
        if piece[3] >= least:
            continue
        for step in (1, -1):
            end, size = k, piece[3]
            while size < least and 0 <= end + step < len(pieces):
                end += step
                size += pieces[end][3]
            first, last = min(k, end), max(k, end)
            if size >= least and (first, last) not in seen:
                seen.add((first, last))
                yield pieces[first][0], pieces[last][1], pieces[first][2], size, _digest(" ".join(p[4] for p in pieces[first : last + 1]))


#: Where a unit stands. A packed unit is its digest, its place, and whether its batch holds the digest again.
_PLACE = pa.struct([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("line", pa.int32()), ("words", pa.int32())])
_PLACES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), *_PLACE])
_PACKED = pa.schema([("range", pa.int64()), ("cells", pa.binary()), ("h1", pa.int64()), ("h2", pa.int64()), ("batch", pa.int64()), ("others", pa.list_(_PLACE))])
_PLACES_DDL = "h1 long, h2 long, doc_id long, start int, end int, line int, words int"
_PACKED_DDL = "range long, cells binary, h1 long, h2 long, batch long, others array<struct<doc_id:long,start:int,end:int,line:int,words:int>>"


def _planes(x: np.ndarray) -> bytes:
    """The bytes of a table of whole numbers by column, all first bytes before all second ones: these compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(x.T).view(np.uint8).reshape(x.shape[1], len(x), 8).transpose(0, 2, 1)).tobytes()


def _unplaned(x: bytes, columns: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1)).view(np.int64).reshape(columns, -1).T


def _sorted(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (h1, h2, document, start, end, ...) by digest and place, and where each digest begins."""
    table = table[np.lexsort((table[:, 4], table[:, 3], table[:, 2], table[:, 1], table[:, 0].view(np.uint64)))]
    return table, np.flatnonzero(np.r_[True, (np.diff(table[:, 0]) != 0) | (np.diff(table[:, 1]) != 0)])


def _listed(of: tuple, least: int, ranges: int):
    def packed(docs: array, spans: array, digests: bytearray, batch: int) -> pa.RecordBatch:
        table = np.column_stack([np.frombuffer(digests, np.int64).reshape(-1, 2), np.frombuffer(docs, np.int64), np.frombuffer(spans, np.int32).reshape(-1, 4)])
        table, first = _sorted(table)
        times = np.diff(np.r_[first, len(table)])
        heads = np.column_stack([table[first], times > 1])
        which = ((heads[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, np.diff(which) != 0])
        cells = [_planes(heads[lo:hi]) for lo, hi in zip(cuts, [*cuts[1:], len(heads)], strict=True)]
        others, again = np.delete(table, first, 0), times > 1
        places = pa.StructArray.from_arrays([pa.array(others[:, 2 + k]).cast(f.type) for k, f in enumerate(_PLACE)], fields=list(_PLACE))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(times[again] - 1)], pa.int32()), places)
        front = [pa.array(which[cuts]), pa.array(cells, pa.binary()), *(pa.nulls(len(cells), f.type) for f in list(_PACKED)[2:])]
        rear = [pa.nulls(len(lists), pa.int64()), pa.nulls(len(lists), pa.binary()), pa.array(heads[again, 0]), pa.array(heads[again, 1]), pa.array(np.full(len(lists), batch)), lists]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y.cast(x.type)]) for x, y in zip(front, rear, strict=True)], schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, spans, digests = array("q"), array("i"), bytearray()
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                for *span, digest in chain.from_iterable(listed(text, least) for listed in of):
                    docs.append(doc)
                    spans.extend(span)
                    digests += digest
                if len(docs) >= PACK_UNITS:
                    yield packed(docs, spans, digests, number)
                    docs, spans, digests = array("q"), array("i"), bytearray()
                    number += 1
        if docs:
            yield packed(docs, spans, digests, number)

    return run


_KEPT = pa.schema([*_PLACES, ("kept_doc_id", pa.int64()), ("kept_start", pa.int32()), ("kept_end", pa.int32()), ("more", pa.bool_()), ("own", pa.bool_())])
_KEPT_DDL = f"{_PLACES_DDL}, kept_doc_id long, kept_start int, kept_end int, more boolean, own boolean"


def _repeated(packed: pa.Table) -> pa.Table:
    """Of one hash range: the occurrences of repeated digests, with the one that stays (``own``: it is that one)."""
    table, first = _sorted(np.concatenate([_unplaned(x.as_py(), 8) for x in packed["cells"]]))
    times = np.diff(np.r_[first, len(table)])
    more = np.logical_or.reduceat(table[:, 7] > 0, first)
    some = np.repeat((times > 1) | more, times)
    own = np.zeros(len(table), bool)
    own[first] = True
    kept, more = table[np.repeat(first, times)][some, 2:5], np.repeat(more, times)[some]
    table, own = table[some], own[some]
    columns = [*table[:, :7].T, *kept.T, more, own]
    return pa.Table.from_arrays([pa.array(np.ascontiguousarray(c)).cast(f.type) for c, f in zip(columns, _KEPT, strict=True)], schema=_KEPT)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: tuple = (units,), least: int = LEAST_WORDS) -> DataFrame:
    """-> ``doc_id, start, end, words, kept_doc_id, kept_start``: every span to remove and the occurrence that stays.

    Offsets count characters from 0; a sentence inside a line that is itself removed is not listed.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-chars // RANGE_CHARS))
    found = keep(texts.mapInArrow(_listed(of, least, ranges), _PACKED_DDL), "units")
    same = keep(found.where("cells is not null").select("range", "cells").groupBy("range").applyInArrow(_repeated, _KEPT_DDL), "repeats")
    stays = same.where("own and more").select("h1", "h2", "kept_doc_id", "kept_start", "kept_end")
    others = found.where("cells is null").select("h1", "h2", "batch", "others").join(stays, ["h1", "h2"]).repartition("batch", "h1")
    others = others.select(F.explode("others").alias("at"), "kept_doc_id", "kept_start", "kept_end").select("at.*", "kept_doc_id", "kept_start", "kept_end")
    again = same.select(others.columns).union(others).where("doc_id <> kept_doc_id or start >= kept_end")
    again = again.select("doc_id", "line", "start", "end", "words", F.struct(F.col("kept_doc_id").alias("doc_id"), F.col("kept_start").alias("start")).alias("kept")).distinct()
    lines = again.groupBy("doc_id", "line").agg(F.collect_list(F.struct("start", "end", "words", "kept")).alias("spans"), F.max(F.struct((F.col("start") == F.col("line")).alias("own"), "end")).alias("whole"))
    spans = lines.select("doc_id", "line", "whole", F.explode("spans").alias("s"))
    longest = (F.col("s.start") == F.col("line")) & (F.col("s.end") == F.col("whole.end"))
    within = F.col("whole.own") & (F.col("s.end") <= F.col("whole.end")) & ~longest
    return spans.where(~within).select("doc_id", "s.start", "s.end", "s.words", F.col("s.kept.doc_id").alias("kept_doc_id"), F.col("s.kept.start").alias("kept_start"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``repeated_spans`` of lines, sentences and runs of short ones; spans of runs may overlap."""
    return repeated_spans(docs, id_col, text_col, (units, runs), least)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without its spans and the white space right after each."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at : max(at, start)])
        at = max(at, end)
        while at < len(text) and text[at].isspace():
            at += 1
    return "".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with every repeated span removed; ``n_chars``, if there is one, follows the text."""
    key, cut = (next(n for n in (f"{'_' * k}{name}" for k in range(1, 99)) if n not in {c.lower() for c in docs.columns}) for name in ("doc", "spans"))
    spans = repeated_passages(docs, id_col, text_col, least).groupBy(F.col("doc_id").alias(key)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cut))
    wide = docs.join(spans, docs[id_col].cast("long") == spans[key], "left").drop(key)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cut in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                texts.append(without(text.as_py(), [(c["start"], c["end"]) for c in cut.as_py()]) if cut.is_valid else text.as_py())
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    out = wide.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
