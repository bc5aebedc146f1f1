"""Layers counted together, reports, and greedy assignment, against plain versions."""

from collections import Counter

from quirework.operators import figures, rules
from quirework.queries import QUERIES
from quirework.queries_repairs import LAYERS
from quirework.queries_scans import _figures

SF = "/root/testdata/sf0.001"


def test_layers_and_report(spark):
    a = spark.createDataFrame([(1, "missing", "blocks"), (1, "missing", "blocks"), (2, "extra", "warns")], "doc_id long, rule string, severity string")
    g = spark.createDataFrame([(1, "orphan", "warns")], a.schema)
    counted = rules.all_layers(A=a, G=g)
    assert {tuple(r) for r in counted.collect()} == {(1, "A", "missing", "blocks", 2), (2, "A", "extra", "warns", 1), (1, "G", "orphan", "warns", 1)}
    got = {r.doc_id: (r.passed, r.text) for r in rules.report(counted).collect()}
    assert got == {1: (False, "FAIL A missing: 2\nwarn G orphan: 1"), 2: (True, "warn A extra: 1")}


def test_every_layer_reaches_the_gate(spark):
    """The gate's counts are those of the layers' own queries, and every layer has at least one row."""
    rows = QUERIES["gate_layers"](spark, SF).collect()
    assert {r.layer for r in rows} == {"0", "A", "B", "C", "D", "E", "F", "G"}
    assert {"figure_missing", "figure_extra"} <= {r.rule for r in rows if r.layer == "E"}
    assert {"section_missing", "section_tail"} & {r.rule for r in rows if r.layer == "D"} and {"file_small", "file_blank"} <= {r.rule for r in rows if r.layer == "F"}
    own = Counter()
    for r in QUERIES["key_compare"](spark, SF).where("status <> 'ignored'").collect():
        own[r.doc_id, "A", r.status] += 1
    for r in QUERIES["findings"](spark, SF).collect():
        own[r.doc_id, "G", r.rule] += 1
    for r in QUERIES["gap_verdicts"](spark, SF).where("verdict <> 'resolved'").collect():
        own[r.book, "B", f"{r.gap}_gap"] += 1
    assert {(r.doc_id, r.layer, r.rule): r.n for r in rows if r.layer in "ABG"} == own
    maths = Counter(r.rule for r in rows if r.layer == "C" for _ in range(r.n))
    assert maths == {r.rule: r.n for r in QUERIES["maths_counts"](spark, SF).collect()}
    assert not spark._jsparkSession.sharedState().cacheManager().numCachedEntries()


def test_greedy_assignment_equals_plain_version(spark):
    got = {(r.page, r.fig_idx): r.label for r in QUERIES["greedy_assignment"](spark, SF).collect()}
    pages = {}
    for r in _figures(spark, SF).collect():
        pages.setdefault(r.page, []).append(r)
    want = {}
    for page, rows in pages.items():
        left = sorted((r.y2, str(r.vec_id)) for r in rows)
        for r in sorted(rows, key=lambda r: r.vec_id):
            near = [(abs(r.y - y), k) for k, (y, _) in enumerate(left) if abs(r.y - y) < figures.REACH]
            want[page, r.vec_id] = left.pop(min(near)[1])[1] if near else None
    assert got == want and None in want.values()


def test_command_line(spark, tmp_path, capsys):
    from quirework.__main__ import main

    assert main(["list"]) == 0 and "gate_summary" in capsys.readouterr().out.split()
    assert main(["run", "order_rollup", SF, f"{tmp_path}/a"], spark) == 0 and spark.read.parquet(f"{tmp_path}/a").count() == 1
    assert main(["gate", SF, f"{tmp_path}/b"], spark) == 1
    every = sorted({r.code for r in rules.RULES.values()} - {"S"} | set(LAYERS))
    assert main(["gate", SF, f"{tmp_path}/c", "--disable", *every], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/b").count() == spark.read.parquet(f"{tmp_path}/c").count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_command_line_options(spark, tmp_path):
    """Ignored keys, figures by hand, the other scheme and repaired lines, each against the layer's own query."""
    from quirework.__main__ import main
    from quirework.queries_repairs import layers

    only = [code for code in LAYERS if code not in "AE"] + sorted({r.code for r in rules.RULES.values()})
    was = {(r.doc_id, r.rule): r.n for r in layers(spark, SF, only).collect()}
    missing = QUERIES["key_compare"](spark, SF).where("status = 'missing'").select("doc_id", "key")
    missing.coalesce(1).write.json(f"{tmp_path}/keys")
    hand = QUERIES["figure_completeness"](spark, SF).where("status = 'missing'").select("ch", "label")
    hand.coalesce(1).write.json(f"{tmp_path}/hand")
    assert main(["gate", SF, f"{tmp_path}/out", "--disable", *only, "--ignore", f"{tmp_path}/keys", "--manual", f"{tmp_path}/hand", "--fix", f"{tmp_path}/fixed"], spark) == 0
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {r.doc_id: r.n_warning for r in rows if r.n_warning} == {d: sum(n for (e, rule), n in was.items() if e == d and rule not in ("missing", "figure_missing")) for d in {d for d, rule in was if rule not in ("missing", "figure_missing")}}
    assert {"missing", "figure_missing"} <= {rule for _, rule in was} and spark.read.parquet(f"{tmp_path}/fixed").columns == ["doc_id", "line_no", "line"]
    two = layers(spark, SF, [c for c in only if c != "E"] + ["E"], "two-level").collect()
    assert two and {r.layer for r in two} == {"A"} and {(r.doc_id, r.rule): r.n for r in two} != was


def test_embedded_figures(spark):
    from pyspark.sql import functions as F

    from quirework.functions.text import shown_in

    rows = spark.createDataFrame([('<img src="_extract/figure/a.png">', "a.png"), ('<img src="figure/a.png">', "a.png"), (None, "a.png")], "line string, file string")
    assert [r[0] for r in rows.select(shown_in(F.col("line"), F.col("file"))).collect()] == [True, False, None]
