"""Patterns are looked for only where they can match, and texts are trimmed on the right only where space may stand."""

import pytest
from pyspark.sql import functions as F

from quirework.functions import patterns as P
from quirework.functions.text import SPACES, lead, matched, strip

TEXTS = [
    "", " ", "a", "> **证明**：a", " > **例1**", "\t>\t**定理**", "\u3000> **例**", ">> a", "---", "--- ", "----x", "## a", "#", "####### a", "**定义** a", "  **证明**", "**(2)** a", "$$", "> $$", "$- a",
    "(1) a", "（2）b", "    1. a", "- (i) a", "{a", " { ", "（式 (1.2)）", "Ã© a", "x â€ y", "ï»¿", "\uFFFD", "\\[x", "\\mathrm x", "\\left.\\frac", "a → b", None,
]


@pytest.mark.parametrize("pattern,meant", [("^##? ", (False, "#")), ("^#{1,6}\\s", (False, "#")), ("^>{0,2}a", (False, "")), ("^\\s*>\\s+\\*\\*a", (True, ">")), ("^a|b", (False, "")), ("^(?:a|b)", (False, "")), ("^\\$\\$.*", (False, "$$")), ("a", (False, "")), ("^---+\\s*$", (False, "---"))])
def test_lead(pattern, meant):
    assert lead(pattern) == meant


def test_guarded_patterns_match_as_before(spark):
    patterns = [v for n, v in vars(P).items() if n.isupper() and isinstance(v, str) and not n.startswith(("RAISED", "LOWERED"))] + [r"\\[\[\]]", "|".join(P.BAD_MACROS), r"^##\s+§", r"^>\s+>", r"^\$\$.*\$\$$"]
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    differ = F.array_compact(F.array(*[F.when(~matched(F.col("t"), p).eqNullSafe(F.col("t").rlike(p)), F.lit(p)) for p in patterns]))
    assert rows.select("t", differ.alias("d")).where("size(d) > 0").collect() == []


def test_only_texts_that_may_end_in_space_are_trimmed_on_the_right(spark):
    texts = [a + b + c for a in ("", " ", "\u3000\t") for b in ("", "x", "定", "é", "~", "\x7f") for c in ("", " ", "\n", "\x85", "\u2003 ")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("got"))
    assert [(r.t, r.got) for r in rows.collect() if r.got != r.t.strip(SPACES)] == []
    assert "ltrim(" in rows._jdf.queryExecution().optimizedPlan().toString()
