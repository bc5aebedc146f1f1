"""Blocks of a summary: the first formatting stage, quotes that leaked, separators between items, and the whole format run.

What a line becomes depends on a state (inside a block, inside a quoted item) and on the solid line that follows the blanks
and separators after it. Both are windows over the lines as they are, so each stage is one pass, whatever it inserts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import strip
from ..plans.lines import after, before, count_before, dealt, latch, line_context, parted
from ..plans.stored import stored
from . import rewriters
from .rewriters import numbered
from .rules import _is

# Fixed values of the document format: what opens a block, a quoted item, a proof's outline; what ends them.
BLOCK = r"^\*\*[^*]+\*\*.*[:：]"
OUTLINE = r"\*\*证明(?:思路|梗概|概要)\*\*"
SECTION = r"^#{2,6}\s"
WORD_END = r"(?:[^\p{L}\p{N}_]|$)"
NESTED_LABEL = rf"^>\s+>\s+\*\*(?:证明|证|例|证明思路|证明梗概|证明概要|定理|引理|推论|命题|定义){WORD_END}"
QUOTED_ITEM = (
    r"^>\s+\*\*(?:定义|定理|引理|推论|命题|注|注记|评注|例|假设|证明(?:思路|梗概|概要)?|习题|问题|断言|公理"
    rf"|Definition|Theorem|Lemma|Proposition|Corollary|Conjecture|Claim|Example|Remark|Assumption|Proof|Axiom|Exercise|Problem|Hypothesis|Algorithm){WORD_END}"
)
TOP_ITEM = r"^\*\*(?:定义|定理|引理|推论|命题|断言)"
#: Lines up to which two items are neighbours.
NEAR = 100


def _one(when: Column, *lines: Column) -> Column:
    return F.when(when, F.array(*lines)).otherwise(F.array().cast("array<string>"))


def quote_stage(lines: DataFrame) -> DataFrame:
    """Nested labels on one level, outlines of proofs quoted (and cut from the line that they end), a ``---`` between blocks.

    Between two blocks stand a blank line, a separator and a blank line, whatever blanks and separator stood there; before a
    heading and at the end a block is closed by a separator. No blank line follows a quote there.
    """
    flat = F.when(_is("line", NESTED_LABEL), F.regexp_replace("line", r"^>\s+>\s+", "> ")).otherwise(F.col("line"))
    ctx = line_context(lines.withColumn("line", flat))
    at = F.regexp_instr("line", F.lit(OUTLINE))
    ctx = ctx.withColumn("at", F.coalesce(at, F.lit(0)))
    lead = F.regexp_replace(F.expr("substring(line, 1, at - 1)"), r"\s+$", "")
    ctx = ctx.withColumn("lead", F.when((F.col("at") > 1) & ~F.startswith("line", F.lit("> ")), lead).otherwise(""))
    outline = F.col("at") > 0
    ctx = ctx.withColumns({
        "outline": outline,
        "section": ~outline & _is("line", SECTION),
        "starts": F.when(outline, _is("lead", BLOCK) & (F.col("lead") != "")).otherwise(~_is("line", SECTION) & _is("line", BLOCK)),
        "gap": F.col("blank") | F.col("dash"),
    })
    ctx = ctx.withColumn("inside", latch(F.col("outline") | F.col("starts"), F.col("section")))
    solid = F.when(~F.col("gap"), F.struct("line_no", "starts", "section", (F.col("outline") | F.col("bqi")).alias("quoted"), "dashes"))
    ctx = ctx.withColumn("dashes", count_before(F.col("dash")))
    ctx = ctx.withColumns({"was": before(solid), "next": after(solid)})
    total = F.sum(F.col("dash").cast("int")).over(Window.partitionBy("doc_id"))
    # Separators behind a line up to the next solid one, and between a solid line and the one before.
    behind = F.coalesce(F.col("next.dashes"), total) - F.col("dashes") - F.col("dash").cast("int")
    between = F.col("dashes") - F.coalesce(F.col("was.dashes"), F.lit(0))
    ctx = ctx.withColumns({"behind": behind, "between": between, "all_dashes": total})
    block_next = F.coalesce(F.col("next.starts"), F.lit(False))
    closes_next = F.col("next").isNull() | F.col("next.section")
    gone = F.col("inside") & ((block_next & ((F.col("blank") & (F.col("behind") <= 1)) | (F.col("dash") & (F.col("behind") == 0)))) | (closes_next & F.col("blank") & (F.col("behind") == 0)))
    quoted = F.coalesce(F.col("was.quoted"), F.lit(False))
    rule = F.concat(_one((F.col("between") > 1) | ~quoted, F.lit("")), F.array(F.lit("---"), F.lit("")))
    opened = F.concat(_one((F.col("between") == 0) & ~quoted, F.lit("")), _one(F.col("between") == 0, F.lit("---")))
    quote = F.concat(F.lit("> "), F.expr("substring(line, at)"))
    said = (
        F.when(F.col("outline") & F.startswith("line", F.lit("> ")), F.array("line"))
        .when(F.col("outline"), F.concat(_one(F.col("starts") & F.col("inside"), F.lit("\x01")), _one(strip(F.col("lead")) != "", F.col("lead")), F.array(quote)))
        .when(F.col("starts"), F.concat(_one(F.col("inside"), F.lit("\x01")), F.array("line")))
        .when(F.col("section"), F.concat(F.when(F.col("inside"), opened).otherwise(F.array().cast("array<string>")), F.array("line")))
        .when(F.col("gap") & gone, F.array().cast("array<string>"))
        .otherwise(F.array("line"))
    )
    said = F.flatten(F.transform(said, lambda x: F.when(x == "\x01", rule).otherwise(F.array(x))))
    # The end of the text closes the last block: what the last lines leave decides how.
    opens = F.col("outline") | F.col("starts")
    ends_inside = F.when(F.col("gap"), F.col("inside")).otherwise(opens | (F.col("inside") & ~F.col("section")))
    last_dash = F.when(F.col("gap"), F.col("between") + F.col("dash").cast("int") > 0).otherwise(False)
    last_quoted = F.when(F.col("gap"), quoted).otherwise(F.col("outline") | F.col("bqi"))
    last = F.col("n1").isNull() & ends_inside & ~last_dash
    return numbered(ctx, F.concat(said, _one(last & ~last_quoted, F.lit("")), _one(last, F.lit("---"))))


def leaked_quotes(lines: DataFrame) -> DataFrame:
    """Everything between a quoted item's label and the next item, separator or heading joins its quote; a ``---`` parts two quoted items.

    Several blank lines become one quoted one; quoted blanks right before a statement at top level go.
    """
    ctx = line_context(lines)
    opens, stands, ends = _is("line", QUOTED_ITEM), _is("line", TOP_ITEM), F.col("dash") | _is("line", SECTION)
    ctx = ctx.withColumns({"opens": opens, "stands": stands & ~opens, "ends": ends & ~opens & ~stands})
    ctx = ctx.withColumn("inside", latch(F.col("opens"), F.col("stands") | F.col("ends")))
    empty = (F.regexp_replace("line", r"\s+$", "") == ">") | (F.col("inside") & F.col("blank"))
    ctx = ctx.withColumn("empty", empty & ~F.col("stands") & ~F.col("opens"))
    ctx = ctx.withColumn("then", after(F.when(~F.col("empty"), F.col("stands"))))
    popped = F.col("empty") & F.coalesce(F.col("then"), F.lit(False))
    again = F.col("blank") & strip(F.col("p1")).isin("", ">")
    none = F.array().cast("array<string>")
    new = (
        F.when(F.col("opens"), F.concat(_one(F.col("inside"), F.lit("---"), F.lit("")), F.array("line")))
        .when(popped, none)
        .when(~F.col("inside") | F.col("stands") | F.col("ends") | F.col("bq"), F.array("line"))
        .when(F.col("blank"), F.when(again, none).otherwise(F.array(F.lit("> "))))
        .otherwise(F.array(F.concat(F.lit("> "), "line")))
    )
    return numbered(ctx, new)


def separators_between(lines: DataFrame) -> DataFrame:
    """A blank line, ``---`` and a blank line between neighbouring items that nothing parts; the first item's own blank lines go."""
    ctx = line_context(lines)
    item = _is("line", P.STATEMENT) | _is("line", P.ITEM_EXAMPLE)
    ctx = ctx.withColumns({"item": item, "stops": count_before(F.col("dash") | _is("line", SECTION))})
    mark = F.when(F.col("item"), F.struct("line_no", "stops"))
    ctx = ctx.withColumns({"from_": before(mark), "to": F.when(F.col("item"), F.struct("line_no", "stops")).otherwise(after(mark))})
    pair = (F.col("to.line_no") - F.col("from_.line_no") <= NEAR) & (F.col("to.stops") == F.col("from_.stops"))
    ctx = ctx.withColumn("solid", after(F.when(~F.col("blank"), F.col("line_no"))))
    trails = F.col("blank") & (F.col("solid") == F.col("to.line_no"))
    ctx = ctx.withColumns({"pair": F.coalesce(pair, F.lit(False)), "trails": F.coalesce(trails, F.lit(False))})
    before_blank = F.coalesce(strip(F.col("p1")) == "", F.lit(False)) & (F.col("line_no") - 1 > F.col("from_.line_no"))
    here = F.col("pair") & (F.col("item") | F.col("trails")) & ~before_blank
    gone = F.col("pair") & F.col("blank") & ~F.col("trails")
    rule = F.array(F.lit(""), F.lit("---"), F.lit(""))
    return numbered(ctx, F.when(gone, F.array().cast("array<string>")).when(here, F.concat(rule, F.array("line"))).otherwise(F.array("line")))


def format_steps(number: bool = False) -> dict:
    """The stages of the format run, by name; ``number`` numbers the steps of proofs."""
    numbering = {"proof_steps": rewriters.proof_steps} if number else {}
    return {
        "example_proof_merged": rewriters.example_proof_merged,
        "quote_stage": quote_stage,
        **numbering,
        "heading_separators": rewriters.heading_separators,
        "split_example_proof": rewriters.split_example_proof,
        "separators_between": separators_between,
    }


def formatted(lines: DataFrame, number: bool = False) -> DataFrame:
    """The whole format run: its stages, then maths edits until nothing changes."""
    from .braces import edited, settled

    for nth, step in enumerate(format_steps(number).values()):
        lines = step(parted(lines) if nth else lines)
    # The rounds are a stage of their own: with the six stages before them in one task, most of its code was never compiled.
    return settled(dealt(stored(lines, "formatted"), text="line"), edited)[0]
