"""Nearest boxes and greedy labels against plain versions, with hot places and far boxes."""

import random

import duckdb
import numpy as np
import pandas as pd

from quirework.operators import figures
from quirework.queries import ORACLES, QUERIES

BOX = "k int, {} long, x double, y double"


def test_nearest_equals_plain_version(spark):
    rng = random.Random(2)
    left = [(rng.randrange(3), i, float(rng.randrange(-50, 50)), float(rng.randrange(-90, 90))) for i in range(120)]
    right = [(rng.randrange(3), i, float(rng.randrange(-40, 40)), float(rng.randrange(-60, 60))) for i in range(90)]
    left += [(0, 500 + i, 7.0, 7.0) for i in range(60)] + [(1, 600, 1e7, -1e7), (9, 601, 0.0, 0.0), (0, 602, None, 1.0)]
    right += [(0, 900 - i, 7.0, 8.0) for i in range(60)] + [(1, 700, 4e5, 3e5), (7, 701, 0.0, 0.0), (0, 702, 1.0, None), (8, 800, 5.0, 5.0)]
    left.append((8, 603, -3.0, 2.0))
    rows = figures.nearest(spark.createDataFrame(left, BOX.format("a")).repartition(3), spark.createDataFrame(right, BOX.format("b")), ["k"], "a", "b").collect()
    want = set()
    for k, i, x, y in left:
        near = [(abs(y - v) + abs(x - u) / 2, j) for q, j, u, v in right if q == k and None not in (x, y, u, v)]
        if near:
            want.add((k, i, min(near)[1], min(near)[0]))
    assert {(r.k, r.a, r.b, r.distance) for r in rows} == want and len(rows) == len(want)
    plain = figures.nearest_within(spark.createDataFrame(left, BOX.format("a")), spark.createDataFrame(right, BOX.format("b")), ["k"], "a", "b").collect()
    assert {(r.k, r.a, r.b, r.distance) for r in plain} == want
    assert figures.nearest(spark.createDataFrame([], BOX.format("a")), spark.createDataFrame(right, BOX.format("b")), ["k"], "a", "b").count() == 0


def test_labels_are_taken_as_in_a_plain_search():
    rng = random.Random(4)
    for _ in range(300):
        refs = [(float(rng.randrange(0, 1500, 50)), rng.choice("abcdefghij")) for _ in range(rng.randrange(12))]
        figs = [float(rng.randrange(0, 1800, 25)) for _ in range(rng.randrange(12))]
        got = figures._taken(pd.DataFrame({"y": figs}), pd.DataFrame(refs, columns=["y", "label"]))
        want, used = [], set()
        for at in figs:
            near = [(abs(at - y), y, label) for y, label in sorted(refs) if label not in used and abs(at - y) < figures.REACH]
            want.append(min(near)[2] if near else None)
            used.add(want[-1])
        assert got == want


def test_a_page_of_many_figures_is_no_square():
    n = 40_000
    refs = pd.DataFrame({"y": [i * 0.5 for i in range(n)], "label": [f"r{i}" for i in range(n)]})
    got = figures._taken(pd.DataFrame({"y": [float(n // 4)] * n}), refs)
    assert len({x for x in got if x}) == sum(x is not None for x in got) == sum(abs(i * 0.5 - n // 4) < figures.REACH for i in range(n))


def test_vectors_are_rounded_as_floats(spark, tmp_path):
    """Products that floats round to a half, and negative zeros: figures stand where the twins put them."""
    x = (np.random.default_rng(3).permutation(np.arange(-400.5, 401)) / 1000).astype("f4")
    product = x * np.float32(1000)
    half = x[(product % 1 == 0.5) & (product.astype(float) != x.astype(float) * 1000)][:160]
    assert len(half) == 160
    vectors = [[float(v) for v in half[k : k + 4]] for k in range(0, 160, 4)] + [[-1e-4, -2e-4, -3e-4, -1e-5]]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("crop_widths", "page_nearest_caption", "polygon_centres", "text_in_boxes", "nearest_caption"):
        ours, theirs = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLES[name])
        assert sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, theirs.select(*ours.columns).fetchall())), name
