"""Centroid clustering (k-means) in exact integers.

Components are ``floor(64 * x)``. Vectors are packed into blocks once, written to the shared folder and read as blocks in
every round. A block's squared distances are ``|x|^2 - 2 x.c + |c|^2`` with one float64 matrix product; as long as
``dims * (|x|max + |c|max)^2`` is below 2^53, every term and every partial sum of it is an integer that a float64 holds, so
the product is exact in any order of summation. Rows beyond that bound are told by 64-bit integer differences, and
rows beyond 64 bits by Python's integers. Sums, counts and inertia meet in ``treeAggregate`` as Python's integers.
Each task sends ``k`` sums whatever it has read, so one vector that a third of the rows hold costs no more than others.

Defined cases: vectors that are null, have another number of components or hold a null or non-finite one are left out
(so is one whose scaled component leaves the range of a double). Repeated rows and null ids count as vectors of their
own; among the first centroids equal hashes go by the components, rows without an id come last. Fewer vectors than ``k``
give as many centroids; no vector, no row. Ties of distance go to the smaller number, an empty centroid stays. A distance
or inertia beyond 64 bits is given as the largest long; clusters are exact nevertheless. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import store
from .vectors import BLOCK_DDL, EXACT, as_long, integers, matrix, packed, whole

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64.0

_DDL = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance (int64, or Python's integers where they need more) of each row's nearest centroid.

    ``x`` holds integer-valued float64, ``centroids`` Python's integers.
    """
    most = max(map(abs, centroids.ravel().tolist()), default=0)
    reach = np.abs(x).max(axis=1, initial=0) + float(most)
    bound = x.shape[1] * reach * reach
    near, wide = bound < EXACT / 2, bound >= 2.0**62
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object if wide.any() else np.int64)
    if near.any():
        rows, c = x[near], centroids.astype(np.float64)
        d = (rows * rows).sum(axis=1)[:, None] - 2 * (rows @ c.T) + (c * c).sum(axis=1)
        cluster[near] = d.argmin(axis=1)
        distance[near] = d.min(axis=1).astype(np.int64)
    for some, kind in ((~near & ~wide, np.int64), (wide, object)):
        if some.any():
            rows = integers(x[some]) if kind is object else x[some].astype(np.int64)
            d = np.stack([((rows - c.astype(kind)) ** 2).sum(axis=1) for c in centroids], axis=1)
            cluster[some] = d.argmin(axis=1)
            distance[some] = d.min(axis=1)
    return cluster, distance


def _sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python's integers."""
    small = np.abs(x).max(initial=0) * max(len(x), 1) < 2.0**62
    return x.astype(np.int64).sum(axis=0).astype(object) if small else integers(x).sum(axis=0)


def _gathered(blocks: DataFrame, centroids: np.ndarray, dims: int, sums: bool) -> list:
    """Of each centroid: count, distance summed, and component sums if asked for."""
    spark, k = blocks.sparkSession, len(centroids)
    held = spark.sparkContext.broadcast(centroids)

    def add(told: list, row) -> list:
        x = matrix(row.lengths, row.cells, dims)
        cluster, distance = nearest(x, held.value)
        for j in np.unique(cluster):
            own = cluster == j
            n, inertia, sum_ = told[j]
            told[j] = (n + int(own.sum()), inertia + sum(distance[own].tolist()), sum_ + _sums(x[own]) if sums else sum_)
        return told

    def merge(a: list, b: list) -> list:
        return [tuple(p + q for p, q in zip(x, y, strict=True)) for x, y in zip(a, b, strict=True)]

    told = blocks.rdd.treeAggregate([(0, 0, np.zeros(dims, object))] * k, add, merge)
    held.destroy()
    return told


def first_centroids(vectors: DataFrame, k: int, scale: float) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest."""
    ints = F.transform("vec", lambda x: F.floor(F.lit(scale) * x))
    rows = vectors.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256).asc_nulls_last(), ints).limit(k).collect()
    return np.array([[int(np.floor(scale * v)) for v in r.vec] for r in rows], object)


def clusters(df: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: float = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """-> ``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every whole vector of ``dims`` components."""
    spark = df.sparkSession
    vectors = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    vectors = vectors.where((F.size("vec") == dims) & whole(F.transform("vec", lambda x: F.lit(scale) * x)))
    blocks = spark.read.schema(BLOCK_DDL).parquet(store(packed(vectors.withColumn("asked", F.lit(False)), scale), "vectors"))
    centroids = first_centroids(vectors, k, scale)
    if not len(centroids):
        return spark.createDataFrame([], _DDL)
    for _ in range(rounds):
        told = _gathered(blocks, centroids, dims, sums=True)
        centroids = np.array([[s // n for s in sum_.tolist()] if n else old.tolist() for old, (n, _, sum_) in zip(centroids, told, strict=True)], object)
    inertia = [i for _, i, _ in _gathered(blocks, centroids, dims, sums=False)]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    held = spark.sparkContext.broadcast((centroids, [as_long(i) for i in inertia], as_long(sum(inertia)), digests))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, inertia, all_inertia, digests = held.value
        for batch in batches:
            for ids, lengths, cells in zip(*(batch.column(c) for c in ("ids", "lengths", "cells")), strict=True):
                cluster, distance = nearest(matrix(lengths.values.to_numpy(), cells.as_py(), dims), centroids)
                at = pa.array(cluster, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.values, at, pa.array(list(map(as_long, distance.tolist())), pa.int64()), pa.array(inertia, pa.int64()).take(at), pa.array([all_inertia] * len(at), pa.int64()), pa.array(digests, pa.string()).take(at)],
                    names=["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return blocks.mapInArrow(run, _DDL)

