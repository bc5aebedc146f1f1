"""Chains of rewriters read their lines once: no step joins a document's lines with themselves."""

import pytest

from quirework.operators import rewriters as W
from quirework.plans.lines import md_lines

TEXT = "**定理1** a\n\n**例** b\n> **例2** c\n---\n> **例3** d\n> x\n\n> y\n> **证明** z\n**定义** e"


@pytest.mark.parametrize("step", [W.add_separators, W.strip_unlabeled, W.repaired, lambda lines: W.changes(lines, W.repaired(lines))])
def test_no_join_and_one_branch(spark, step):
    lines = md_lines(spark.createDataFrame([(1, TEXT)], "doc_id long, text string"))
    plan = step(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("posexplode(split(") <= 2


def test_separators_and_bags(spark):
    lines = md_lines(spark.createDataFrame([(1, TEXT), (2, "**定理** a\n# h\n**定理** b\n" + "x\n" * 100 + "**定理** c\n**定理** d")], "doc_id long, text string"))
    made = W.add_separators(lines)
    got = {d: [r.line for r in made.where(f"doc_id = {d}").orderBy("line_no").collect()] for d in (1, 2)}
    assert got[1] == ["**定理1** a", "", "**例** b", "---", "> **例2** c", "---", "> **例3** d", "> x", "", "> y", "> **证明** z", "---", "**定义** e"]
    assert got[2][-3:] == ["**定理** c", "---", "**定理** d"] and got[2].count("---") == 1
    assert {(r.doc_id, r.removed, r.added) for r in W.changes(lines, made).collect()} == {(1, 0, 2), (2, 0, 1)}
