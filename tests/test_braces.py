"""Brace repair, maths edits to a fixed point, and steps that fired, against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quirework.operators import braces, repairs
from quirework.operators.braces import GROUP_COMMANDS, edited, fired, settled
from quirework.plans.lines import md_lines

SCHEMA = "doc_id long, text string"


def walked(text):
    """One character after the other: maths mode, open groups, and an escaped brace that waits."""
    out, mode, depth, waits, k = "", "", 0, False, 0
    while k < len(text):
        two = text[k : k + 2]
        if two == "$$" or (two[0] == "$" and mode != "$$"):
            sign = "$$" if two == "$$" else "$"
            mode = "" if mode == sign or (sign == "$$" and mode.startswith("$$")) else sign
            out, depth, waits, k = out + sign, 0, False, k + len(sign)
        elif mode and two == "\\{":
            seen = out[-20:].rstrip()
            loses = seen.endswith(("_", "^")) or (seen.endswith("}") and depth <= 2) or re.search(rf"\\(?:{GROUP_COMMANDS})$", seen)
            out, depth, waits, k = out + two[bool(loses) :], depth + bool(loses), waits or not loses, k + 2
        elif mode and two == "\\}":
            loses = depth > 0 and text[k + 2 : k + 3] != "}"
            waits = waits and depth > 0
            out, depth, k = out + two[loses:], depth - loses, k + 2
        elif mode and two[0] in "{}":
            gains = two[0] == "}" and not depth and waits
            waits = waits and not (two[0] == "}" and not depth)
            out, depth, k = out + "\\" * gains + two[0], depth + 1 if two[0] == "{" else max(0, depth - 1), k + 1
        else:
            out, k = out + two[0], k + 1
    return out


def test_braces_equal_plain_walk(spark):
    rng = random.Random(9)
    bits = ["$", "$$", "\\{", "\\}", "{", "}", "_", "^", "\\mathcal", "\\sqrt", "\\frac", " ", " " * 19, " " * 21, "x", "\n", "\\", "\\in", "\x01", "\t"]
    weights = [3, 3, 6, 6, 4, 4, 3, 2, 3, 2, 2, 3, 1, 1, 4, 2, 1, 1, 0, 1]
    rows = [(k, "".join(rng.choices(bits, weights, k=rng.randrange(70)))) for k in range(400)]
    rows += [(900, ""), (901, "$x_\\{a\\}$ and $\\{x}$ and \\{y}"), (902, "$$\n\\mathbf \\{A\\}\n\\{a\\}\n$$"), (903, "$" + "_\\{" * 3000 + "\\}" * 3000)]
    lines = md_lines(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {r.doc_id: r.text for r in braces.texts(braces.braces(lines)).collect()}
    want = {k: walked(t) for k, t in rows}
    assert got == want and sum(want[k] != t for k, t in rows) > 100


TEXTS = [
    (1, "a\n$$x+y$$\nb"), (2, "> q\n> > $$\n> > z\n> > $$"), (3, "text\n$$\nx\n$$\nend"), (4, "\\$\\$\nx\n\\$\\$"), (5, "p\n<div>\nq\n</div>\nr"), (6, "$$a\nb$$"),
    (7, "plain"), (8, ""), (9, ">   $$\n> x\n> $$"), (10, "- (i) a\n(1) b"), (11, "> **定理** c"), (12, "> $$x+y$$\n> t"),
]


def test_edits_reach_a_fixed_point(spark):
    lines = md_lines(spark.createDataFrame(TEXTS, SCHEMA))
    out, rounds = settled(lines, edited)
    got = {r.doc_id: r.text for r in braces.texts(out).collect()}
    assert got[1] == "a\n\n$$\nx+y\n$$\nb" and got[5] == "p\n\n<div>\nq\n</div>\n\nr" and got[11] == "**定理** c" and got[12] == "> $$\n> x+y\n> $$\n> t"
    assert got[10] == "- (i) a\n\n(1) b" and got[7] == "plain" and got[8] == "" and got[4].startswith("$$\n") and got[9].startswith("> $$")
    told = {r.doc_id: r.rounds for r in rounds.collect()}
    assert set(told) == {k for k, _ in TEXTS} and told[7] == told[8] == 0 and told[1] >= 2
    again, more = settled(out, edited)
    assert {r.doc_id: r.text for r in braces.texts(again).collect()} == got and {r.rounds for r in more.collect()} == {0}


def test_a_step_without_fixed_point_raises(spark):
    lines = md_lines(spark.createDataFrame(TEXTS[:2], SCHEMA))
    with pytest.raises(ValueError, match="still change"):
        settled(lines, lambda x: x.withColumn("line", F.concat("line", F.lit("x"))), most=2)


def test_steps_that_fired(spark):
    lines = md_lines(spark.createDataFrame([(1, "\\in t x"), (2, "$x_\\{a\\}$"), (3, "a")], SCHEMA))
    out, told = fired(lines, repairs.MATHS_STEPS)
    assert {tuple(r) for r in told.collect()} == {(1, "spaced_commands"), (2, "braces")}
    assert {r.doc_id: r.text for r in braces.texts(out).collect()} == {1: "\\int x", 2: "$x_{a}$", 3: "a"}
