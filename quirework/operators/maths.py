"""Maths-markup rules over ``line_context``: findings ``doc_id, line_no``.

They register with the other rules under code C but run over their own context, as one layer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import beyond, strip
from ..plans.lines import after, count_before, forward, rows_before, rows_through
from .rules import Rule, _is, flagged, met, tight

MATHS_RULES: dict[str, Callable[[DataFrame], DataFrame]] = {}


def maths(find: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    MATHS_RULES[find.__name__] = find
    return find


#: The rules that judge a line by its prepared context alone, as columns.
MATHS_LINES: dict[str, Callable[[], Column]] = {}


def prepared(ctx: DataFrame) -> DataFrame:
    """``line_context`` with the columns that maths rules share; what a rule does not use is not computed."""
    lone = F.col("t") == "$$"
    ctx = plain_text(display_state(ctx))
    return ctx.withColumns({"p2": F.lag("line", 2).over(forward()), "earlier": count_before(lone), "later": after(F.when(lone, True))})


def maths_line(flag: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    MATHS_LINES[flag.__name__] = flag
    return maths(flagged(flag, prepared))


@maths_line
def escaped_display() -> Column:
    return F.col("t").isin("\\$\\$", "> \\$\\$")


@maths_line
def nested_display() -> Column:
    return _is("t", r"^>\s+>") & F.contains("t", F.lit("$$"))


@maths_line
def one_line_display() -> Column:
    quote = F.startswith("t", F.lit("> $$")) & F.endswith("t", F.lit("$$")) & (F.length("t") > 6)
    plain = F.startswith("t", F.lit("$$")) & F.endswith("t", F.lit("$$")) & (F.length("t") > 4)
    return quote | plain


@maths_line
def attached_display() -> Column:
    """``$$`` that has formula on one side only."""
    first, last = F.contains("t", F.lit("$$")) & F.col("t").rlike(r"^(?:> \s*)?\$\$"), F.endswith("t", F.lit("$$"))
    once = ~F.contains(F.expr("substring(t, 1, length(t) - 2)"), F.lit("$$"))
    return (first & ~last) | (last & ~first & once)


@maths_line
def div_blanks() -> Column:
    """HTML blocks without a blank line before ``<div`` or after ``</div>``."""
    return (F.startswith("t", F.lit("<div")) & tight("p1")) | ((F.col("t") == "</div>") & tight("n1"))


@maths_line
def deep_quoted_display() -> Column:
    return _is("line", P.DEEP_QUOTED_FENCE)


def display_state(ctx: DataFrame) -> DataFrame:
    """Adds ``lone`` (an unquoted ``$$`` line), ``quoted_fence``, and the parities of both before the line.

    A lone fence on the first or last line of a document does not count.
    """
    edge = F.col("p1").isNull() | F.col("n1").isNull()
    ctx = ctx.withColumns({"lone": F.col("t") == "$$", "quoted_fence": F.startswith("t", F.lit("> $$"))})
    return ctx.withColumns({
        "in_plain": count_before(F.col("lone") & ~edge) % 2 == 1,
        "in_quoted": count_before(F.col("quoted_fence")) % 2 == 1,
        "edge": edge,
    })


@maths_line
def display_needs_blank() -> Column:
    """An opening ``$$`` right under text, or an opening ``> $$`` right under a quote's content."""
    prev, following = strip(F.col("p1")), strip(F.col("n1"))
    plain = F.col("lone") & ~F.col("edge") & ~F.col("in_plain") & ~following.isin("", "$$") & (prev != "") & ~F.startswith(prev, F.lit(">"))
    quote = F.col("quoted_fence") & ~F.col("in_quoted") & ~prev.isin(">", "")
    return F.coalesce(plain, F.lit(False)) | F.coalesce(quote, F.lit(False))


def outside() -> Column:
    """Whether a line is neither a display fence nor between two."""
    return ~(F.col("lone") | F.col("quoted_fence") | F.col("in_plain") | F.col("in_quoted"))


@maths
def odd_dollars(ctx: DataFrame) -> DataFrame:
    """Documents whose inline ``$`` do not pair up; the finding stands at line 0 with their number."""
    bare = F.regexp_replace("line", r"\\\$", "")
    counts = display_state(ctx).where(outside()).groupBy("doc_id").agg(F.sum(F.length(bare) - F.length(F.replace(bare, F.lit("$"), F.lit("")))).alias("dollars"))
    return counts.where("dollars % 2 = 1").select("doc_id", F.lit(0).alias("line_no"), "dollars")


@maths_line
def bad_macros() -> Column:
    return outside() & _is("line", "|".join(P.BAD_MACROS))


@maths
def maths_in_fence(ctx: DataFrame) -> DataFrame:
    """A closed code fence whose lines look like a formula or diagram; found at its opening line."""
    ctx = ctx.withColumn("fence", F.startswith("t", F.lit("```")))
    ctx = ctx.withColumn("nth", F.sum(F.col("fence").cast("int")).over(rows_through()))
    signs = F.col("line").rlike(beyond(P.FENCE_SIGNS))
    for token in P.FENCE_TOKENS:
        signs = signs | F.contains("line", F.lit(token))
    blocks = ctx.where("nth % 2 = 1").groupBy("doc_id", "nth").agg(F.min("line_no").alias("line_no"), F.max(signs & ~F.col("fence")).alias("maths"))
    closed = ctx.where("fence").groupBy("doc_id").agg(F.max("nth").alias("fences"))
    return blocks.join(closed, "doc_id").where("maths and nth < fences").select("doc_id", "line_no")


def plain_text(ctx: DataFrame) -> DataFrame:
    """Adds ``plain``: the line without inline maths and code, null inside code fences and display maths.

    Spans are cut within the line; fences and ``$$`` switch by parity. A line that opens and closes display maths on
    its own loses the span between.
    """
    fence = F.startswith("t", F.lit("```"))
    ctx = ctx.withColumn("in_code", count_before(fence) % 2 == 1)
    text = F.col("line")
    for pattern, new in ((r"\\\[.*?\\\]", " "), (r"\\[\[\]]", r"\$\$"), (r"\\\(.*?\\\)", " "), (r"\\\$", " "), (r"`[^`]*`", " "), (r"\$\$.*?\$\$", " "), (r"(^|[^$])\$[^$]+\$", "$1 ")):
        text = F.regexp_replace(text, pattern, new)
    live = ~fence & ~F.col("in_code")
    marked = reduce(Column.__or__, [F.contains("line", F.lit(x)) for x in ("$", "\\", "`")])
    ctx = ctx.withColumn("cut", F.when(live, F.when(marked, text).otherwise(F.col("line"))))
    marks = F.when(live, (F.length("cut") - F.length(F.replace(F.col("cut"), F.lit("$$"), F.lit("")))) / 2).otherwise(0)
    ctx = ctx.withColumn("fences", marks.cast("int"))
    ctx = ctx.withColumn("display", F.coalesce(F.sum("fences").over(rows_before()), F.lit(0)) % 2 == 1)
    return ctx.withColumn("plain", F.when(live & ~F.col("display") & (F.col("fences") == 0), F.col("cut")))


@maths_line
def raw_arrows() -> Column:
    return F.coalesce(F.col("plain").rlike(beyond(P.RAW_ARROWS)), F.lit(False))


@maths
def naked_commands(ctx: DataFrame) -> DataFrame:
    return plain_text(ctx).where(_is("plain", P.NAKED_COMMAND)).select("doc_id", "line_no", F.regexp_extract("plain", f"({P.NAKED_COMMAND})", 1).alias("command"))


@maths_line
def swallowed_prefix() -> Column:
    fence = F.startswith("t", F.lit("```"))
    return ~fence & ~F.col("in_code") & ~F.startswith("t", F.lit("$$")) & _is("line", P.SWALLOWED_PREFIX)


@maths_line
def equation_note() -> Column:
    """An equation number under a formula instead of inside it."""
    ends = lambda c: F.coalesce(F.endswith(strip(F.col(c)), F.lit("$$")), F.lit(False))
    return _is("t", P.EQUATION_NOTE) & (ends("p1") | (F.coalesce(strip(F.col("p1")) == "", F.lit(False)) & ends("p2")))


@maths_line
def escaped_from_quote() -> Column:
    """An unquoted ``$$`` under a quote's content, with a later ``$$`` to close it."""
    lone = F.col("t") == "$$"
    return lone & F.coalesce(F.startswith(strip(F.col("pnb")), F.lit("> ")), F.lit(False)) & F.coalesce(F.col("later"), F.lit(False))


@maths_line
def list_gap() -> Column:
    """A top-level ``(n)`` right under a sub-item."""
    return _is("line", P.TOP_ITEM) & _is("p1", P.BULLET)


@maths_line
def bare_struct_in_quote() -> Column:
    return _is("line", P.BARE_QUOTED_STATEMENT)


@maths_line
def unclosed_display() -> Column:
    """The last of an odd number of unquoted ``$$`` lines."""
    lone = F.col("t") == "$$"
    return lone & (F.col("earlier") % 2 == 0) & F.col("later").isNull()


def maths_findings(ctx: DataFrame) -> DataFrame:
    """Findings of all maths rules: line rules in one pass, the others beside it."""
    lines = met(prepared(ctx), [Rule("C", name, MATHS_RULES[name], flag=flag) for name, flag in MATHS_LINES.items()])
    others = [find(ctx).select("doc_id", F.lit("C").alias("code"), F.lit(name).alias("rule"), F.lit("blocks").alias("severity"), "line_no") for name, find in MATHS_RULES.items() if name not in MATHS_LINES]
    return reduce(DataFrame.unionByName, [lines, *others])
