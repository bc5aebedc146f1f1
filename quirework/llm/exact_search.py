"""Exact search for the vectors with the largest inner products.

Components are ``floor(64 * x)``. All vectors are packed into blocks in the order of descending length (a range sort;
equal lengths are dealt by id and row, so many copies of a vector don't meet in one task) and written to the shared
folder. A rotation that the singular value decomposition of all vectors gives puts most of their energy into the
first components. Queries are handed out in groups of bounded size, each a broadcast with the longest vectors of the
table, from which every task knows a score that each query reaches anyway. A task goes through its blocks from long to
short: by Cauchy-Schwarz no query needs a block whose length times its own stays below the score that it has; of the
others, partial sums of the first rotated components plus the product of the residual lengths bound every score, and
only pairs whose bound reaches the score are computed, in integers. What each task's queries have kept meets in one
window of a query.

Rotation and bounds are float64 with a margin above their rounding; scores are exact: as a float64 product where the
product of lengths is below 2^53, by Python's integers beyond. A score beyond 64 bits counts as the nearest long.

Defined cases: vectors that are null or hold a null or non-finite component take no part. Where lengths differ, missing
components are 0. Every row is a candidate but the query's own; repeated rows and ids are rows of their own, and a null
id is a candidate that comes last among ties. Fewer candidates than ``k`` are all returned. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .shared import store
from .vectors import BLOCK_DDL, EXACT, as_long, integers, matrix, packed, whole

K, SCALE = 20, 64.0
#: Components of one group of queries, vectors that give the first scores, and components that are rotated at most.
GROUP_CELLS, HEAD, ROTATED = 1 << 20, 512, 256
#: Share of the energy that the partial sums take, and above which share of pairs a whole product is cheaper.
ENERGY, DENSE = 0.9, 0.02
#: Queries whose bounds are computed at once.
STRIP = 512
#: Relative margin of bounds: far above the rounding of sums of float64.
MARGIN = 1e-9

_LEAST = -(1 << 63)
_FOUND = "query long, query_id long, row long, vec_id long, score long"
_BEST = "query long, query_id long, rank int, vec_id long, score long"


class Vectors:
    """Rows of integers with their ids, row numbers and lengths; null ids are the largest number."""

    def __init__(self, x: np.ndarray, ids: list, rows: np.ndarray):
        self.x, self.rows = x, rows
        self.ids = np.array([(1 << 63) - 1 if i is None else i for i in ids], np.int64)
        self.no_id = np.array([i is None for i in ids], bool)
        size = np.maximum(np.abs(x).max(axis=1, initial=0), 1.0)
        self.length = size * np.sqrt(((x / size[:, None]) ** 2).sum(axis=1))

    def rotate(self, rotation: np.ndarray, first: int) -> None:
        """The first rotated components, and the length of what they leave out."""
        d = min(self.x.shape[1], len(rotation))
        self.part = self.x[:, :d] @ rotation[:d, :first]
        size = np.maximum(self.length, 1.0)
        share = ((self.part / size[:, None]) ** 2).sum(axis=1)
        self.rest = self.length * np.sqrt(np.maximum((self.length / size) ** 2 - share, 0) + MARGIN)


def rotation_of(blocks: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Singular vectors of all vectors' first ``ROTATED`` components, and how many hold ``ENERGY`` of their squares."""
    d = max(1, min(width, ROTATED))

    def add(told: np.ndarray, row) -> np.ndarray:
        x = matrix(row.lengths, row.cells, d) / max(row.longest, 1.0)
        return told + x.T @ x

    gram = blocks.rdd.treeAggregate(np.zeros((d, d)), add, lambda a, b: a + b)
    vectors, energy, _ = np.linalg.svd(gram)
    return vectors, int(np.searchsorted(np.cumsum(energy), ENERGY * energy.sum())) + 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of integer-valued rows as longs, whatever their size."""
    return np.array([as_long(sum(p * q for p, q in zip(x, y, strict=True))) for x, y in zip(integers(a).tolist(), integers(b).tolist(), strict=True)], np.int64)


class Kept:
    """The best ``k`` pairs of every query so far, and the score (and id) that a further pair has to beat."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor
        self.full, self.id = np.zeros(len(floor), bool), np.full(len(floor), (1 << 63) - 1)
        self.query, self.score, self.vec_id, self.row = (np.empty(0, np.int64) for _ in range(4))
        self.no_id = np.empty(0, bool)

    def add(self, query: np.ndarray, vec: Vectors, at: np.ndarray, score: np.ndarray) -> None:
        better = (score > self.floor[query]) | (score == self.floor[query]) & (~self.full[query] | (vec.ids[at] <= self.id[query]))
        if not better.any():
            return
        query, at, score = query[better], at[better], score[better]
        q = np.r_[self.query, query]
        score, vec_id, no_id, row = (np.r_[x] for x in ((self.score, score), (self.vec_id, vec.ids[at]), (self.no_id, vec.no_id[at]), (self.row, vec.rows[at])))
        order = np.lexsort((row, no_id, vec_id, ~score, q))
        first = np.flatnonzero(np.r_[True, np.diff(q[order]) != 0])
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.query, self.score, self.vec_id, self.no_id, self.row = q[order], score[order], vec_id[order], no_id[order], row[order]
        last = rank == self.k - 1
        done = self.query[last]
        self.full[done], self.floor[done], self.id[done] = True, self.score[last], self.vec_id[last]


def scan(queries: Vectors, block: Vectors, kept: Kept) -> None:
    """Adds to ``kept`` every pair of a query and another row of the block that can be among its best."""
    reach = queries.length * block.length.max(initial=0)
    open_ = np.flatnonzero(~(reach * (1 + MARGIN) < kept.floor))
    width = min(queries.x.shape[1], block.x.shape[1])
    b = block.x[:, :width]
    for lo in range(0, len(open_), STRIP):
        q = open_[lo : lo + STRIP]
        bound = queries.part[q] @ block.part.T
        bound += np.outer(queries.rest[q], block.rest)
        bound += MARGIN * np.outer(queries.length[q], block.length)
        floor = kept.floor[q][:, None]
        able = ~(bound < floor) | (floor == _LEAST)  # a bound that is no number excludes nothing
        able &= queries.rows[q][:, None] != block.rows[None, :]
        if reach[q].max(initial=0) < EXACT / 2 and able.mean() > DENSE:
            scores = (queries.x[q][:, :width] @ b.T).astype(np.int64)
            row, at = np.nonzero(able & (scores >= floor))
            kept.add(q[row], block, at, scores[row, at])
            continue
        row, at = np.nonzero(able)
        small = queries.length[q[row]] * block.length[at] < EXACT / 2
        scores = np.zeros(len(row), np.int64)
        for n in range(0, len(row), 1 << 16):
            some = slice(n, n + (1 << 16))
            r, c, s = row[some], at[some], small[some]
            part = np.zeros(len(r), np.int64)
            part[s] = np.einsum("ij,ij->i", queries.x[q[r[s]]][:, :width], b[c[s]]).astype(np.int64)
            part[~s] = products(queries.x[q[r[~s]]][:, :width], b[c[~s]])
            scores[some] = part
        kept.add(q[row], block, at, scores)


def first_scores(queries: Vectors, head: Vectors, k: int) -> np.ndarray:
    """A score that ``k`` rows of ``head`` reach with each query, or the least one where that isn't known."""
    floor = np.full(len(queries.x), _LEAST)
    width = min(queries.x.shape[1], head.x.shape[1])
    sure = np.flatnonzero(queries.length * head.length.max(initial=0) < EXACT / 2)
    for lo in range(0, len(sure) if len(head.x) > k else 0, STRIP):
        q = sure[lo : lo + STRIP]
        scores = queries.x[q][:, :width] @ head.x[:, :width].T
        scores[queries.rows[q][:, None] == head.rows[None, :]] = -np.inf
        floor[q] = np.partition(scores, -k, axis=1)[:, -k]
    return floor


def _block(row, most: int | None = None) -> Vectors:
    width = max(row.lengths, default=0)
    return Vectors(matrix(row.lengths, row.cells, width)[:most], row.ids[:most], row.row + np.arange(len(row.ids))[:most])


def _groups(blocks: DataFrame, width: int) -> Iterator[Vectors]:
    """The queries, of at most ``GROUP_CELLS`` components each time (or a single block's)."""

    def flush() -> Vectors:
        return Vectors(np.concatenate([x.x for x in held]), [None if no else i for x in held for i, no in zip(x.ids.tolist(), x.no_id.tolist(), strict=True)], np.concatenate([x.rows for x in held]))

    held, size = [], 0
    for row in blocks.where(F.exists("asked", lambda x: x)).toLocalIterator():
        asked = np.flatnonzero(row.asked)
        x = Vectors(matrix(row.lengths, row.cells, width)[asked], [row.ids[i] for i in asked], row.row + asked)
        if held and size + x.x.size > GROUP_CELLS:
            yield flush()
            held, size = [], 0
        held.append(x)
        size += x.x.size
    if held:
        yield flush()


def _best(blocks: DataFrame, queries: Vectors, floor: np.ndarray, rotation: np.ndarray, first: int, k: int) -> DataFrame:
    """The ``k`` best pairs of each query, of what each task has kept."""
    held = blocks.sparkSession.sparkContext.broadcast((queries, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floor = held.value
        queries.rotate(rotation, first)
        kept = Kept(floor.copy(), k)
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(Row(**row))
                block.rotate(rotation, first)
                scan(queries, block, kept)
        q = kept.query
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries.rows[q]), pa.array(queries.ids[q]), pa.array(kept.row), pa.array(kept.vec_id, pa.int64(), mask=kept.no_id), pa.array(kept.score)], names=["query", "query_id", "row", "vec_id", "score"]
        )

    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    found = blocks.drop("asked").sortWithinPartitions(F.desc("longest")).mapInArrow(run, _FOUND)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "query_id", "rank", "vec_id", "score")


def top_products(df: DataFrame, asked: Column, k: int = K, scale: float = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """-> ``query`` (its row number), ``query_id, rank, vec_id, score``: the ``k`` best rows for every row that is asked for.

    ``asked`` is a condition over ``id``, the row's id as a long.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    vectors = vectors.where(whole(F.transform("vec", lambda x: F.lit(scale) * x)))
    length = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    order = (F.desc("length"), F.asc("id"), F.asc("at"))
    ranged = vectors.withColumns({"length": length, "at": F.monotonically_increasing_id(), "asked": F.coalesce(asked, F.lit(False))})
    ranged = ranged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    blocks = spark.read.schema(BLOCK_DDL).parquet(store(packed(ranged, scale), "vectors"))
    top = blocks.orderBy(F.desc("longest"), "row").limit(1).collect()
    if not top:
        return spark.createDataFrame([], _BEST)
    head = _block(top[0], HEAD)
    width = blocks.agg(F.max(F.array_max("lengths"))).first()[0]
    rotation, first = rotation_of(blocks, width)
    paths = [store(_best(blocks, queries, first_scores(queries, head, k), rotation, first, k), "best") for queries in _groups(blocks, width)]
    return spark.read.schema(_BEST).parquet(*paths) if paths else spark.createDataFrame([], _BEST)
