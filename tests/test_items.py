"""Positions of matches, names and ranges, against plain versions."""

import random
import re
import time

from pyspark.sql import functions as F

from quirework.operators import figures, items
from quirework.operators.items import matches

SCHEMA = "id long, text string"


def test_positions_equal_plain_version(spark):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choices(["1.2-3", "2_71", "定理", " ", "x", "\x01", "é", "𝔸", "."], k=rng.randrange(60)))) for k in range(80)] + [(900, None), (901, ""), (902, "1.2-3")]
    got = {(r.id, r.kind, r.nth): (r.said, r.at, r.upto, r.g1, r.g2, r.g3) for r in matches(spark.createDataFrame(rows, SCHEMA), items.NUMBER, items.GARBLED).collect()}
    want = {(k, kind, n): (m[0].replace("\x01", "\x02"), m.start(), m.end(), *m.groups()) for k, t in rows for kind, p in enumerate((items.NUMBER, items.GARBLED)) for n, m in enumerate(re.compile(p, re.ASCII).finditer(t or ""))}
    assert got == want and len(want) > 50
    assert {r.nth for r in matches(spark.createDataFrame(rows, SCHEMA), "zz(z)").collect()} == set()


def test_many_matches_in_one_text(spark):
    n = 100_000
    rows = spark.createDataFrame([(1, "".join(f"({i % 10}) é " for i in range(n)))], SCHEMA)
    began = time.perf_counter()
    told = matches(rows, r"\((\d)\)").agg(F.count("*"), F.sum("at"), F.max("upto"), F.sum(F.col("g1").cast("int"))).first()
    assert tuple(told) == (n, 6 * n * (n - 1) // 2, 6 * n - 3, 45 * n // 10)
    assert time.perf_counter() - began < 60


def test_names_are_distinct_beyond_two_digits(spark):
    rows = [(ch, p, i, f"{ch}.1" if i % 150 == 7 else None) for ch in (3, 99, 100, 1234) for p in range(2) for i in range(160)]
    named = figures.file_names(spark.createDataFrame(rows, "ch int, page int, fig_idx int, label string")).collect()
    assert len({r.name for r in named}) == len(rows)
    assert {"ch03_unnamed_01", "ch100_unnamed_100", "ch1234_unnamed_316", "ch99_fig99.1_3"} <= {r.name for r in named}


def test_ranges_however_wide(spark):
    rng = random.Random(6)
    ranges = [(k, a := rng.randrange(-60, 60), a + rng.randrange(-2, 30)) for k in range(14)] + [(20, 40, 2**31 - 1), (21, -(2**31), -70), (13, 5, 5)]
    points = [(p,) for p in range(-90, 130)] + [(5,), (None,), (2**31 - 1,), (-(2**31),), (10**6,)]
    frame = figures.assign_ranges(spark.createDataFrame(points, "p int"), spark.createDataFrame(ranges, "map_idx int, start int, end int"), "p")
    want = {}
    for (p,) in points:
        held = [r for r in sorted(ranges) if p is not None and r[1] <= p <= r[2]]
        want[p] = held[0] if held else (None,) * 3
    rows = frame.collect()
    assert len(rows) == len(points) and all((r.map_idx, r.start, r.end) == want[r.p] or (r.map_idx == 13 and want[r.p][0] == 13) for r in rows)
