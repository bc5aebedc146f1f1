"""Chapters as a stream: each is told once, when its last page arrives, in whatever order pages come and after a restart.

State is kept by chapter, not by book, so that a book of any size spreads over the cluster; it lives in the
query's checkpoint. Pages that come twice, or after their chapter was told, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "book long, ch int, state string, pages int"


def _seen(bits: bytes, numbers: list[int]) -> bytearray:
    """A bit for each page of the chapter that has come; it reaches as far as the last of them."""
    out = bytearray(bits)
    for n in numbers:
        out.extend(bytes(max(0, n // 8 + 1 - len(out))))
        out[n // 8] |= 1 << n % 8
    return out


def readied(pages: DataFrame, chapters: DataFrame, patience_ms: int | None = None) -> DataFrame:
    """``book, ch, state, pages``: ``ready`` once every page of ``start`` to ``end`` has come.

    ``pages(book, page)`` is a stream, ``chapters(book, ch, start, end)`` a table. With ``patience_ms`` a chapter that gets no
    page for so long is told as ``waiting``, with the number of pages that it has, each time that it stalls.
    """
    met = pages.select("book", "page").join(chapters.select("book", "ch", "start", "end"), "book").where("page between start and `end`")
    rows = met.select(F.col("book").cast("long"), F.col("ch").cast("int"), F.col("start").cast("int"), F.col("end").cast("int"), F.col("page").cast("int"))

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book, ch, start, end = key
        bits, done = state.get if state.exists else (b"", False)
        told = lambda what, n: pd.DataFrame({"book": [book], "ch": [ch], "state": [what], "pages": [n]})
        if state.hasTimedOut:
            yield told("waiting", int.from_bytes(bits, "little").bit_count())
            return
        if done:
            return
        bits = _seen(bits, [int(p) - start for frame in frames for p in frame["page"]])
        count = int.from_bytes(bits, "little").bit_count()
        if count == end - start + 1:
            state.update((b"", True))
            yield told("ready", count)
            return
        state.update((bytes(bits), False))
        if patience_ms:
            state.setTimeoutDuration(patience_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if patience_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy("book", "ch", "start", "end").applyInPandasWithState(update, OUT, "bits binary, done boolean", "append", timeout)


def passed(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """``book, ch`` of chapters whose end a page of the stream has reached, each once; earlier pages need not have come."""
    met = pages.select("book", "page").join(chapters.select("book", "ch", "end"), "book").where("page >= `end`")
    return met.select("book", "ch").dropDuplicates(["book", "ch"])
