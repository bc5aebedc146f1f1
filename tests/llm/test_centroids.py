import hashlib
import math
import random

import numpy as np
import pytest

from quirework.llm import centroids, vectors
from quirework.llm.centroids import clusters

SCHEMA = "vec_id long, embedding array<double>"
INF, NAN = math.inf, math.nan


def brute(rows, k, rounds, dims):
    """(id, cluster, distance, inertia of the cluster, of all, digest) with Python's integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [[] for _ in cents]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(x) for x in zip(*vs, strict=True)] if vs else c for c, vs in zip(cents, own, strict=True)]
    told = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = [sum(d for _, j, d in told if j == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    long = lambda x: min(x, (1 << 63) - 1)
    return sorted(((i, j, long(d), long(total[j]), long(sum(total)), digest[j]) for i, j, d in told), key=str)


def got(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cluster", "'x' as id").repartition(3)
    return sorted(map(tuple, clusters(frame, **more).collect()), key=str)


def points(seed, n, dims, scale=1.0):
    rng = random.Random(seed)
    return [(i * 3 - 20, [rng.gauss(i % 3, 0.7) * scale for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 2.0**20, 2.0**30, 2.0**60, 1e-9])
def test_equals_brute_force(spark, monkeypatch, scale):
    """Products in floats, in 64-bit integers and in Python's integers; blocks small and large."""
    rows = points(1, 90, 4, scale) + [(7, None), (8, []), (9, [1.0, None, 2.0, 3.0]), (10, [1.0, INF, 2.0, 3.0]), (11, [NAN] * 4), (12, [1.0] * 3), (13, [1.0] * 5), (None, [0.5, -0.5, 1.5, 2.0])]
    rows += rows[:5] + [(rows[0][0], rows[3][1])]  # repeated rows, and an id with two vectors
    want = brute(rows, 5, 3, 4)
    assert got(spark, rows, k=5, rounds=3, dims=4) == want
    monkeypatch.setattr(vectors, "CELLS", 8)
    assert got(spark, rows, k=5, rounds=3, dims=4) == want


def test_tiers_agree_within_a_block():
    """A block with small and huge vectors: each row by the cheapest way that is exact for it."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 50, (60, 3)))
    x[20:40] *= 2.0**22
    x[40:] *= 2.0**50
    cents = vectors.integers(x[[0, 5, 30, 50]])
    cluster, distance = centroids.nearest(x, cents)
    for v, c, d in zip(vectors.integers(x).tolist(), cluster.tolist(), distance.tolist(), strict=True):
        assert (d, c) == min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(cents.tolist()))


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.25, 0.5]) for i in range(40)]
    assert got(spark, same, k=3, rounds=2, dims=2) == brute(same, 3, 2, 2)  # ties go to cluster 0; the others stay empty
    assert {r[1] for r in got(spark, same, k=3, rounds=2, dims=2)} == {0}
    assert got(spark, same[:2], k=16, rounds=1, dims=2) == brute(same[:2], 16, 1, 2)
    assert got(spark, same, k=3, rounds=2, dims=9) == []
    assert clusters(spark.createDataFrame([], SCHEMA)).columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
