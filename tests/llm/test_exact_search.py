import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import exact_search, vectors
from quirework.llm.exact_search import top_products

SCHEMA = "vec_id long, embedding array<double>"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def brute(rows, k, every):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [(-max(LOW, min(HIGH, sum(a * b for a, b in zip(v, w, strict=False)))), i is None, i or 0, i) for m, (i, w) in enumerate(kept) if m != n]
        out += [(q, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(spark, rows, k, every):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "2 as id", "3 as rank").repartition(3)
    return sorted(map(tuple, top_products(frame, F.col("id") % every == 0, k).drop("query").collect()), key=str)


def points(seed, n, dims, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [(i - 9, [(c + rng.gauss(0, 0.3)) * scale * rng.choice((0.1, 1, 3)) for c in rng.choice(centres)]) for i in range(n)]


ODD = [(1000, None), (1005, [1.0, None]), (1010, [math.inf]), (1015, [math.nan]), (1020, []), (1025, [1.0]), (1030, [0.5] * 9), (None, [1.0, -1.0, 2.0])]


@pytest.mark.parametrize("scale", [1.0, 1e-3, 2.0**18, 2.0**24, 2.0**34])
def test_equals_brute_force(spark, monkeypatch, scale):
    """Scores in floats, in whole numbers and beyond 64 bits; other lengths, nulls, repeated rows and ids."""
    rows = points(3, 160, 6, scale) + ODD
    rows += rows[9:14] + [(1, rows[20][1])]
    want = brute(rows, 4, 5)
    assert got(spark, rows, 4, 5) == want
    monkeypatch.setattr(vectors, "CELLS", 40)
    monkeypatch.setattr(exact_search, "GROUP_CELLS", 60)
    monkeypatch.setattr(exact_search, "HEAD", 7)
    monkeypatch.setattr(exact_search, "STRIP", 3)
    monkeypatch.setattr(exact_search, "DENSE", 1.1)
    assert got(spark, rows, 4, 5) == want


def test_ties_and_few_candidates(spark):
    same = [(i, [0.5, 0.25]) for i in range(30)]
    assert got(spark, same, 3, 10) == brute(same, 3, 10)
    assert got(spark, same[:1], 3, 10) == []
    assert got(spark, same[:3], 20, 10) == brute(same[:3], 20, 10)
    assert got(spark, same, 3, 1000) == brute(same, 3, 1000)  # query 0 alone
    assert top_products(spark.createDataFrame([], SCHEMA), F.col("id") == 1).count() == 0
    assert top_products(spark.createDataFrame(same, SCHEMA), F.col("id") > 99).count() == 0


def test_bounds_leave_most_pairs_out():
    """With lengths that differ and a few strong directions, few pairs are computed, and none that counts is lost."""
    rng = np.random.default_rng(4)
    x = np.floor(64 * rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 32)) * rng.lognormal(0, 1, (3000, 1)) + rng.normal(size=(3000, 32)))
    x = x[np.argsort(-(x * x).sum(axis=1))]
    all_ = exact_search.Vectors(x, list(range(3000)), np.arange(3000))
    queries = exact_search.Vectors(x[::50], list(range(0, 3000, 50)), np.arange(0, 3000, 50))
    rotation = np.linalg.svd(x.T @ x)[0]
    kept = exact_search.Kept(exact_search.first_scores(queries, exact_search.Vectors(x[:512], list(range(512)), np.arange(512)), 5), 5)
    looked = []
    add = kept.add
    kept.add = lambda q, b, at, s: (looked.append(len(q)), add(q, b, at, s))
    queries.rotate(rotation, 6)
    for lo in range(0, 3000, 500):
        block = exact_search.Vectors(x[lo : lo + 500], list(range(lo, lo + 500)), np.arange(lo, lo + 500))
        block.rotate(rotation, 6)
        exact_search.scan(queries, block, kept)
    assert all_.length[0] == all_.length.max() and sum(looked) < 0.1 * 60 * 3000
    scores = x[::50] @ x.T
    scores[np.arange(60), np.arange(0, 3000, 50)] = -np.inf
    want = np.sort(scores, axis=1)[:, ::-1][:, :5]
    assert (kept.score.reshape(60, 5) == want).all()
