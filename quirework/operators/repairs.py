"""Repairs of maths markup as line rewriters, and the chain in which they run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import SPACE, strip
from ..plans.lines import after, before, latch, line_context
from . import rewriters
from .braces import braces
from .rewriters import _replaced, numbered
from .rules import _is

_MARKS = "[,;:，；：。、?？)）]"
CD_OPEN, CD_CLOSE = "\\begin{CD}", "\\end{CD}"


def bare_dollars(line: Column) -> Column:
    """Dollar signs outside ``$$`` spans and escapes."""
    rest = F.regexp_replace(F.regexp_replace(line, r"\\.", ""), r"\$\$.*?(?:\$\$|$)", "")
    return F.length(rest) - F.length(F.replace(rest, F.lit("$"), F.lit("")))


def close_dollars(lines: DataFrame) -> DataFrame:
    """An open ``$`` before a display block is closed in front of the mark that ends its line."""
    ctx = line_context(lines)
    opens = (bare_dollars(F.col("line")) % 2 == 1) & F.coalesce(F.startswith(strip(F.col("nnb")), F.lit("$$")), F.lit(False))
    return _replaced(ctx, F.when(opens, F.regexp_replace("line", f"({_MARKS}{SPACE}*)$", "\\$$1")).otherwise(F.col("line")))


def spaced_commands(lines: DataFrame) -> DataFrame:
    """Commands that a blank broke are joined again; twice, as two of them may share the character between."""
    line = F.col("line")
    for pattern, meant in P.BROKEN:
        line = F.regexp_replace(F.regexp_replace(line, pattern, meant), pattern, meant)
    # Every pattern begins with a backslash, and no other line is searched.
    return _replaced(lines, F.when(F.contains("line", F.lit("\\")), line).otherwise(F.col("line")))


def stray_after_diagram(lines: DataFrame) -> DataFrame:
    """Lone ``$$`` lines right after a diagram go while none further down is left to pair with.

    Of several in a row all but the last go; the last goes if no other ``$$`` line follows it.
    """
    ctx = line_context(lines)
    opens, closes = F.contains("line", F.lit(CD_OPEN)), F.contains("line", F.lit(CD_CLOSE))
    ctx = ctx.withColumn("ends", closes & latch(opens, closes)).withColumn("lone", F.col("t") == "$$")
    ctx = ctx.withColumn("stray", F.col("lone") & F.coalesce(before(F.when(~F.col("lone"), F.col("ends"))), F.lit(False)))
    last = F.coalesce(strip(F.col("n1")), F.lit("")) != "$$"
    gone = F.col("stray") & (~last | after(F.when(F.col("lone"), True)).isNull())
    return numbered(ctx.withColumn("gone", gone).where("not gone"), F.array("line"))


def display_rebuilt(lines: DataFrame) -> DataFrame:
    """Display blocks of lone ``$$`` lines: no blank lines or quote marks inside, a blank line before and after; an open block is closed."""
    ctx = line_context(lines)
    ctx = ctx.withColumn("lone", F.col("t") == "$$").withColumn("nth", F.sum(F.col("lone").cast("int")).over(rewriters.rows_through()))
    opener, closer = F.col("lone") & (F.col("nth") % 2 == 1), F.col("lone") & (F.col("nth") % 2 == 0)
    inner = ~F.col("lone") & (F.coalesce(F.col("nth"), F.lit(0)) % 2 == 1)
    lead = F.regexp_replace("line", f"^{SPACE}+", "")
    body = F.when(F.startswith(lead, F.lit(">")), F.regexp_replace(F.expr("substring(line, instr(line, '>') + 1)"), f"^{SPACE}+", "")).otherwise(lead)
    said = lambda c: F.coalesce(strip(F.col(c)) != "", F.lit(False))
    blank_for = lambda c: F.when(F.startswith(strip(F.col(c)), F.lit(">")), F.lit("> ")).otherwise(F.lit(""))
    none = F.array().cast("array<string>")
    # A block before has set the blank line already.
    above = F.when(said("p1") & (strip(F.col("p1")) != "$$") & (strip(F.col("p1")) != ">"), F.array(blank_for("p1"))).otherwise(none)
    below = F.when(said("n1"), F.array(blank_for("n1"))).otherwise(none)
    open_end = F.when(F.col("n1").isNull() & (F.col("nth") % 2 == 1), F.array(F.lit("$$"))).otherwise(none)
    new = F.when(opener, F.concat(above, F.array(F.lit("$$")))).when(closer, F.concat(F.array(F.lit("$$")), below)).when(inner, F.when(strip(body) == "", none).otherwise(F.array(body))).otherwise(F.array("line"))
    return numbered(ctx, F.concat(new, open_end))


def gaps_quoted(lines: DataFrame) -> DataFrame:
    """Inside a quoted proof or example blank lines and display marks join the quote; nested quotes become one level."""
    ctx = line_context(lines)
    head, ends = _is("line", P.QUOTE_HEAD), _is("line", P.QUOTE_END) & ~F.col("bqi")
    ctx = ctx.withColumn("inside", latch(head, ends) & ~head & ~ends)
    stops = _is("nnb", P.QUOTE_HEAD) | (_is("nnb", P.QUOTE_END) & ~F.startswith(strip(F.col("nnb")), F.lit(">")))
    joined = F.when(F.col("inside") & F.col("blank") & F.col("nnb").isNotNull() & ~stops, "> ").when(F.col("inside") & F.startswith("t", F.lit("$$")) & ~F.col("bqi"), F.concat(F.lit("> "), F.col("t"))).otherwise(F.col("line"))
    return _replaced(ctx, F.when(joined.rlike(r"^\s*>\s+>"), F.regexp_replace(joined, r"^(?:\s*>\s*)+", "> ")).otherwise(joined))


REPAIRS = {f.__name__: f for f in (close_dollars, spaced_commands, stray_after_diagram, display_rebuilt, gaps_quoted)}
#: The maths chain, by name.
MATHS_STEPS = {f.__name__: f for f in (close_dollars, rewriters.wrapping_display, spaced_commands, stray_after_diagram, braces, rewriters.display_without_blanks, rewriters.broken_commands)}


def maths_repaired(lines: DataFrame) -> DataFrame:
    for step in MATHS_STEPS.values():
        lines = step(lines)
    return lines


def single_level(blocks: DataFrame) -> DataFrame:
    """``book, key, label, page`` of items that are numbered without a chapter or section; first of each key."""
    from .items import _first, matches

    rows = matches(blocks, r"(定义|定理|引理|推论|命题|例)\s*(\d+)([^\d.\-·]|$)")
    return _first(rows.withColumns({"label": F.col("g1"), "key": F.concat("g1", F.regexp_replace("g2", "^0+([0-9])", "$1"))}))


# Fixed value of the document format: headings of exercises.
EXERCISE_HEAD = r"^#{1,6}\s.*(?:习题|练习|Exercises?|Problems?)"


def exercise_sections(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no`` of every line in a section of exercises: from its heading to the next other one of its level or above."""
    level = F.when(_is("line", P.HEADING), F.length(F.regexp_extract("line", "^(#+)", 1)))
    ctx = lines.withColumns({"level": level, "exercise": _is("line", EXERCISE_HEAD)})
    last = lambda when: F.max(F.when(when, F.col("line_no"))).over(rewriters.rows_through())
    held = [F.coalesce(last((F.col("level") == k) & F.col("exercise")) > F.coalesce(last((F.col("level") <= k) & ~F.col("exercise")), F.lit(0)), F.lit(False)) for k in range(1, 7)]
    return ctx.withColumn("held", reduce(Column.__or__, held)).where("held").select("doc_id", "line_no")


def exercises(lines: DataFrame) -> DataFrame:
    """Lines that head an exercise or a section of exercises, which a summary leaves out: ``doc_id, line_no``."""
    return lines.where(F.col("line").rlike(r"^(?:>\s*)?\*\*(?:习题|练习|Exercise|Problem)") | F.col("line").rlike(r"^#{1,6}\s.*(?:习题|练习|Exercises?|Problems?)")).select("doc_id", "line_no")


def arrow_ends(lines: DataFrame) -> DataFrame:
    """Arrows of commutative diagrams whose three direction marks differ: ``doc_id, line_no, arrow``.

    An arrow runs from ``@`` and its mark to the next ``@`` or ``&``; a mark opens it, stands between its labels and ends it.
    """
    arrows = F.regexp_extract_all("line", F.lit("@[><VA][^@&]*"), F.lit(0))
    mark = lambda a: F.substring(a, 2, 1)
    wrong = F.filter(arrows, lambda a: F.length(a) - F.length(F.replace(a, mark(a), F.lit(""))) < 3)
    return lines.select("doc_id", "line_no", F.explode(wrong).alias("arrow"))


def after_proof_end(ctx: DataFrame) -> DataFrame:
    """Quoted lines with content below the line of a proof's end mark in the same quote: ``doc_id, line_no``."""
    from .rules import quote_groups

    order = Window.partitionBy("doc_id", "quote").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.col("line").rlike(P.PROOF_END)).over(order), F.lit(False))
    return quote_groups(ctx).withColumn("ended", ended).where("ended and t <> '>'").select("doc_id", "line_no")


def expected_languages(files: DataFrame, books: DataFrame) -> DataFrame:
    """``book, ch, missing``: chapters that lack a summary in a language that their book's language asks for.

    ``files(book, ch, lang)`` are summaries, ``books(book, lang)`` the sources: a Chinese book needs ``cn``, an English one
    ``cn`` and ``en``, any other both and its own.
    """
    own = F.col("of")
    wanted = F.when(own == "cn", F.array(F.lit("cn"))).when(own == "en", F.array(F.lit("cn"), F.lit("en"))).otherwise(F.array(F.lit("cn"), F.lit("en"), own))
    held = files.groupBy("book", "ch").agg(F.collect_set("lang").alias("held"))
    rows = held.join(books.select("book", F.col("lang").alias("of")), "book").withColumn("missing", F.array_sort(F.array_except(wanted, "held")))
    return rows.where("size(missing) > 0").select("book", "ch", "missing")
