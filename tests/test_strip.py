"""Trimming looks at the ends of a text alone."""

import sys

from pyspark.sql import functions as F

from quirework.functions.text import strip


def test_strip_is_that_of_python_and_no_pattern(spark):
    spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    texts = ["", " ", "a", "x\n", "\n x \n\n", *(f"{c}{c}a{c}b{c}" for c in spaces), *(f"{c}b{c}" for c in "​﻿᠎\x00>中"), "".join(spaces), None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", strip(F.col("x")).alias("x"))
    assert {r.i: r.x for r in rows.collect()} == {i: x if x is None else x.strip() for i, x in enumerate(texts)}
    assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_blanks_inside_a_line_are_not_searched(spark):
    """A pattern for the end tries each of them: with this many it took minutes."""
    rows = spark.range(1).select(F.concat(F.lit(" a"), F.repeat(F.lit(" "), F.lit(300_000)), F.lit("b ")).alias("x"))
    assert rows.select(F.length(strip(F.col("x")))).first()[0] == 300_002
