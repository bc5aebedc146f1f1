"""Documents dealt over as many tasks as their texts need."""

from quirework import queries
from quirework.plans.lines import line_context

SF = "/root/testdata/sf0.001"


def test_tasks_follow_the_size_of_the_texts(spark, monkeypatch):
    chars = queries.read(spark, SF, "documents").selectExpr("sum(length(text))").first()[0]
    want = sorted(map(tuple, queries.QUERIES["source_sections"](spark, SF).collect()), key=repr)
    assert queries.lines_of(spark, SF).rdd.getNumPartitions() == queries.read(spark, SF, "documents").rdd.getNumPartitions()
    monkeypatch.setattr(queries, "TASK_CHARS", chars // 40 + 1)
    context = line_context(queries.lines_of(spark, SF))
    assert context.rdd.getNumPartitions() == 40
    plan = context._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, queries.QUERIES["source_sections"](spark, SF).collect()), key=repr) == want and want
