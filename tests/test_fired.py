"""Steps that fired: tasks of bounded size, and commands looked for only where a backslash stands."""

from quirework.functions import patterns as P
from quirework.operators import braces, repairs
from quirework.plans.lines import md_lines

SCHEMA = "doc_id long, text string"


def test_steps_get_tasks_by_the_size_of_the_lines(spark, monkeypatch):
    lines = md_lines(spark.createDataFrame([(k, "$x_\\{a\\}$\n\\in t x\nplain") for k in range(200)], SCHEMA))
    seen = []

    def step(rows):
        seen.append(rows.rdd.getNumPartitions())
        return repairs.spaced_commands(rows)

    monkeypatch.setattr(braces, "shares", lambda rows, text: 23, raising=True)
    out, told = braces.fired(lines, {"spaced_commands": step})
    assert seen == [23] and told.count() == 200
    assert {r.text for r in braces.texts(out).collect()} == {"$x_\\{a\\}$\n\\int x\nplain"}


def test_commands_are_looked_for_behind_a_backslash_only(spark):
    assert all(pattern.startswith("\\\\") for pattern, _ in P.BROKEN)
    lines = md_lines(spark.createDataFrame([(1, "\\in t x\n\\in fty\\in f \n\\qquad   x\\quad y\\frac1a{2}\nin t plain")], SCHEMA))
    out = repairs.spaced_commands(lines)
    assert [r.line for r in out.orderBy("line_no").collect()] == ["\\int x", "\\infty\\inf ", "\\qquad x\\quad y\\frac{1}a{2}", "in t plain"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN Contains(line" in plan
