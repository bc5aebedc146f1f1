"""Formulas travel as one row each: their symbols are neither ranked nor counted as rows."""

from quirework.operators import formulas as X


def test_symbols_stay_in_the_row_of_their_formula(spark):
    ours = spark.createDataFrame([(1, 1, r"\alpha x x y z"), (1, 2, r"\beta"), (1, 3, ""), (2, 1, "a b c d e")], "doc_id long, id int, latex string")
    theirs = spark.createDataFrame([(1, 7, r"x y z \alpha"), (1, 8, r"x x y z \alpha w"), (2, 9, "a b c d q"), (1, 9, r"\gamma")], "doc_id long, id int, latex string")
    got = {(r.doc_id, r.id, r.source_id, tuple(r.missing), tuple(r.extra)) for r in X.drift(ours, theirs).collect()}
    # 5 of 6 symbols agree with the second source, 4 of 5 with the first one.
    assert got == {(1, 1, 8, ("w",), ()), (1, 2, None, (), ("\\beta",)), (2, 1, 9, ("q",), ("e",))}
    plan = X.drift(ours, theirs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "collect_list" not in plan
