"""Layers as plug-ins: discovery, order, settings and repairs."""

import pytest
from pyspark.sql import functions as F

from quirework.operators import registry, rewriters, rules
from quirework.operators.registry import Layer, Registry, structure
from quirework.plans.lines import line_context, md_lines

PLUGIN = """
from pyspark.sql import functions as F
import plugged_registry
from quirework.operators.registry import Layer
plugged_registry.REGISTRY.register(Layer("{code}", {order},
    lambda lines, s: lines.where(F.contains("line", F.lit(s["word"]))).select("doc_id", F.lit("word").alias("rule"), F.lit(s["severity"]).alias("severity"), "line_no"),
    lambda lines, s: lines.withColumn("line", F.concat("line", F.lit("{code}"))), {fix}, {{"word": "bad", "severity": "warns"}}))
"""


def lines(spark, *texts):
    return md_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_modules_of_a_package_are_found_and_run_in_order(spark, tmp_path, monkeypatch):
    (tmp_path / "plugged_registry.py").write_text("from quirework.operators.registry import Registry\nREGISTRY = Registry()\n")
    (tmp_path / "plugged").mkdir()
    (tmp_path / "plugged" / "__init__.py").write_text("")
    for code, order, fix in (("X", 2, 1), ("Y", 1, 2)):
        (tmp_path / "plugged" / f"{code.lower()}.py").write_text(PLUGIN.format(code=code, order=order, fix=fix))
    monkeypatch.syspath_prepend(str(tmp_path))
    import plugged_registry

    reg = plugged_registry.REGISTRY
    assert reg.discover("plugged") == ["X", "Y"] and reg.discover("plugged") == []
    table = lines(spark, "bad\nworse", "fine")
    told = reg.found(table, {"X": {"word": "worse"}, "Q": {"word": "no"}}, {"X": {"severity": "blocks"}}).collect()
    assert [tuple(r) for r in told] == [(0, "Y", "word", "warns", 1), (0, "X", "word", "blocks", 2)]
    assert [r.code for r in reg.found(table, disabled=["X"]).collect()] == ["Y"]
    assert {r.line for r in reg.repaired(table).collect()} == {"badXY", "worseXY", "fineXY"}
    assert {r.line for r in reg.repaired(table, disabled="X").collect()} == {"badY", "worseY", "fineY"}


def test_codes_are_told_apart():
    reg = Registry()
    reg.register(Layer("A", 1, lambda x, s: x))
    with pytest.raises(ValueError, match="two layers"):
        reg.register(Layer("A", 2, lambda x, s: x))
    with pytest.raises(ValueError, match="in no order"):
        reg.register(Layer("B", 2, lambda x, s: x, lambda x, s: x))


def test_structure_rules_and_their_repairs(spark):
    table = lines(spark, "> > a\n---\nb\n> **定理 1** c", "a\n---\nb", "d")
    reg = structure()
    own = {(r.doc_id, r.code, r.rule, r.line_no) for r in rules.findings(line_context(table)).collect()}
    assert {(r.doc_id, r.code, r.rule, r.line_no) for r in reg.found(table).collect()} == own != set()
    mild = reg.found(table, {"L": {"severity": "warns"}}).where("code = 'L'").select("severity").distinct().collect()
    assert [r.severity for r in mild] == ["warns"]
    assert [code for code, _ in sorted(registry.FIXES.items(), key=lambda x: x[1][0])] == ["H", "G", "I", "J", "K", "L", "M", "N"]
    assert {tuple(r) for r in reg.repaired(table).collect()} == {tuple(r) for r in rewriters.repaired(table).collect()}
    only = reg.repaired(table, disabled=set(reg.layers) - {"L"})
    assert [r.line for r in only.where(F.col("doc_id") == 1).orderBy("line_no").collect()] == ["a", "", "---", "", "b"]
