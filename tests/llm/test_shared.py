import random

import pytest

from quirework.llm import shared


def brute(edges):
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {x: find(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("kind", ["random", "path", "star", "loops", "empty"])
def test_components(spark, kind):
    rng = random.Random(kind)
    ids = rng.sample(range(-500, 5000), 120)
    edges = {
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(90)],
        "path": list(zip(ids, ids[1:], strict=False)),
        "star": [(ids[0], x) for x in ids[1:]] * 2,
        "loops": [(x, x) for x in ids],
        "empty": [],
    }[kind]
    found = shared.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == brute(edges)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://somewhere"

    class Session:
        sparkContext = Cluster()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_the_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared.shared_dir(spark) == shared.shared_dir(spark) and spark.conf.get("spark.checkpoint.dir", None) == before
