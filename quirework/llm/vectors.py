"""Vectors of integers in packed blocks: what centroid clustering and exact top-k search read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components that one block holds (8 bytes each), unless a single vector has more.
CELLS = 1 << 17
#: Every integer below is a float64, and so is every sum of products whose bound stays below it.
EXACT = 2.0**53
_LONG = 1 << 63

BLOCK_DDL = "row long, ids array<long>, asked array<boolean>, lengths array<int>, cells binary, longest double"
_NAMES = ["row", "ids", "asked", "lengths", "cells", "longest"]
_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.float64()]


def whole(vec: Column) -> Column:
    """Whether a vector is there and none of its components is null or not finite."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def packed(rows: DataFrame, scale: float) -> DataFrame:
    """``id long, vec array<double>, asked boolean`` -> blocks of ``floor(scale * component)`` in the order of the rows.

    ``scale`` is a power of two, so the products are exact, and the floor of a float64 is one again: nothing is rounded.
    Rows of a block are numbered from ``row`` on, with other numbers in every block; ``longest`` is the largest
    Euclidean length in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids, asked = (batch.column(c) for c in ("row", "id", "asked"))
            lists = batch.column("vec").cast(pa.large_list(pa.float64()))
            ends, flat = lists.offsets.to_numpy(), np.floor(scale * lists.values.to_numpy(zero_copy_only=False))
            lo = 0
            while lo < len(lists):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + CELLS, side="right")) - 1)
                cells, lengths = flat[ends[lo] : ends[hi]], np.diff(ends[lo : hi + 1])
                size = max(np.abs(cells).max(initial=0), 1.0)
                squares = np.bincount(np.repeat(np.arange(hi - lo), lengths), (cells / size) ** 2, hi - lo)
                part = slice(lo, hi)
                values = [row[lo].as_py(), ids[part].to_pylist(), asked[part].to_pylist(), lengths.tolist(), cells.tobytes(), size * float(np.sqrt(squares.max()))]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES, strict=True)], names=_NAMES)
                lo = hi

    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "asked", "vec").mapInArrow(run, BLOCK_DDL)


def matrix(lengths, cells: bytes, width: int) -> np.ndarray:
    """The vectors of a block as rows of ``width`` components; missing ones are 0, further ones are left out."""
    lengths, flat = np.asarray(lengths, np.int64), np.frombuffer(cells, np.float64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    row, column = np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[column < width], column[column < width]] = flat[column < width]
    return out


def integers(x: np.ndarray) -> np.ndarray:
    """Integer-valued floats as Python's integers, which have no bound."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def as_long(x: int) -> int:
    """The nearest 64-bit integer."""
    return max(-_LONG, min(_LONG - 1, int(x)))
