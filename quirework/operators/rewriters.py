"""Line rewriters: ``doc_id, line_no, line`` -> the same columns, repaired and numbered anew.

Edits are row projections, deletions and insertions; what a rewriter needs to know of other lines comes from window
columns, so a document never leaves Spark's rows. ``CHAIN`` is the order in which they apply.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import strip
from ..plans.lines import after, before, count_before, forward, latch, line_context, rows_through
from .rules import _is, dash_inside, empty_runs, in_display, is_quoted, follows_item, proof_after_list_line, quote_groups, tight


def numbered(rows: DataFrame, lines: Column | str) -> DataFrame:
    """Rows ``doc_id, line_no`` with an array of lines each -> a line table."""
    out = rows.select("doc_id", "line_no", F.posexplode(lines).alias("pos", "line"))
    order = Window.partitionBy("doc_id").orderBy("line_no", "pos")
    return out.select("doc_id", F.row_number().over(order).alias("line_no"), "line")


def _replaced(ctx: DataFrame, line: Column) -> DataFrame:
    return ctx.select("doc_id", "line_no", line.alias("line"))


def unwrap_struct(lines: DataFrame) -> DataFrame:
    """Statement labels leave their quote; bare ``>`` lines that do not join two quoted lines become blank."""
    label = (_is("line", P.QUOTED_STATEMENT) & ~_is("line", P.QUOTED_PROOF_OF)) | (_is("line", P.QUOTED_STATEMENT_CN) & ~_is("line", P.QUOTED_PROOF_OF))
    lines = _replaced(lines, F.when(label, F.regexp_replace("line", r"^\s*>\s+", "")).otherwise(F.col("line")))
    ctx = line_context(lines)
    content = lambda c: F.coalesce(F.startswith(c, F.lit(">")) & ~strip(F.col(c)).isin("", ">"), F.lit(False))
    return _replaced(ctx, F.when(F.col("bq") & (F.col("t") == ">") & ~(content("p1") & content("n1")), "").otherwise(F.col("line")))


def unwrap_statement(lines: DataFrame) -> DataFrame:
    """Quoted lines between a statement's head and its first proper quote lose the quote if any of them is statement content."""
    ctx = line_context(lines)
    head = _is("line", P.STATEMENT_OR_FORMULA)
    ctx = ctx.withColumn("inside", latch(head, _is("line", P.QUOTE_LEGIT)) & ~head & ~_is("line", P.QUOTE_LEGIT)).withColumn("item", F.sum(head.cast("int")).over(rows_through()))
    wrapped = F.max(F.col("inside") & _is("line", P.QUOTE_WRAPPED)).over(Window.partitionBy("doc_id", "item"))
    bare = F.regexp_replace("line", r"^\s*>\s*", "")
    for pattern, new in ((r"^（([0-9a-zA-Z]+)）", r"**($1)**"), (r"^- （([0-9a-zA-Z]+)）", "- ($1)")):
        bare = F.regexp_replace(bare, pattern, new)
    return _replaced(ctx.withColumn("wrapped", wrapped), F.when(F.col("inside") & F.col("bqi") & F.col("wrapped"), bare).otherwise(F.col("line")))


def strip_unlabeled(lines: DataFrame) -> DataFrame:
    """Content of quotes without an opener loses its ``>``."""
    ctx = line_context(lines)
    fine = _is("decides", P.QUOTE_OPENER) | _is("decides", P.QUOTE_FOOTNOTE) | _is("decides", P.QUOTED_STATEMENT_CN)
    out = F.when(F.col("bqi") & F.col("decides").isNotNull() & ~fine & ~F.regexp_replace("line", r"^\s+", "").isin(">", "> "), F.regexp_replace("line", r"^>\s?", "")).otherwise(F.col("line"))
    return _replaced(quote_groups(ctx, every=True), out)


def add_quote(lines: DataFrame) -> DataFrame:
    ctx = line_context(lines)
    missing = ~F.col("bqi") & ~F.col("head") & (_is("t", P.QUOTE_MISSING) | _is("t", P.FOOTNOTE))
    return _replaced(ctx, F.when(missing, F.concat(F.lit("> "), "line")).otherwise(F.col("line")))


def quote_blanks(lines: DataFrame) -> DataFrame:
    """Blank lines inside a proof or example quote become ``> ``; then bare ``>`` lines at a quote's rim become blank."""
    ctx = line_context(lines)
    off = (_is("line", P.QUOTE_END) & ~F.col("bqi")) | (~F.col("blank") & ~F.col("bq"))
    ends = _is("nnb", P.QUOTE_HEAD) | (_is("nnb", P.QUOTE_END) & ~is_quoted("nnb"))
    ctx = ctx.withColumn("inside", latch(_is("line", P.QUOTE_HEAD), off))
    lines = _replaced(ctx, F.when(F.col("blank") & F.col("inside") & ~ends, "> ").otherwise(F.col("line")))
    bare = lambda c: F.regexp_replace(c, r"\s+$", "") == ">"
    content = lambda c: F.coalesce(F.startswith(c, F.lit(">")) & ~bare(c), F.lit(False))
    rows = lines.withColumns({"p1": F.lag("line").over(forward()), "n1": F.lead("line").over(forward())})
    return _replaced(rows, F.when(bare("line") & (F.col("line") != "> ") & ~(content("p1") & content("n1")), "").otherwise(F.col("line")))


def add_separators(lines: DataFrame) -> DataFrame:
    """A ``---`` before every item that directly follows another one."""
    return numbered(follows_item(line_context(lines)), F.when(F.col("second"), F.array(F.lit("---"), F.col("line"))).otherwise(F.array("line")))


def drop_dash_in_item(lines: DataFrame) -> DataFrame:
    """Deletes separators inside an item, each with one blank line after it."""
    ctx = dash_inside(line_context(lines))
    follows = F.coalesce(F.lag("wrong").over(forward()), F.lit(False)) & F.col("blank")
    return numbered(ctx.withColumn("gone", F.col("wrong") | follows).where("not gone"), F.array("line"))


def list_blank(lines: DataFrame) -> DataFrame:
    ctx = line_context(lines)
    return numbered(ctx, F.when(proof_after_list_line(), F.array(F.col("line"), F.lit(""))).otherwise(F.array("line")))


def separator_blanks_added(lines: DataFrame) -> DataFrame:
    """A blank line on both sides of every separator; of two separators in a row the first one's blank serves both."""
    ctx = line_context(lines)
    blank, none = F.array(F.lit("")), F.array().cast("array<string>")
    above = F.when(tight("p1") & (strip(F.col("p1")) != "---"), blank).otherwise(none)
    return numbered(ctx, F.when(F.col("dash"), F.concat(above, F.array("line"), F.when(tight("n1"), blank).otherwise(none))).otherwise(F.array("line")))


def display_unquoted(lines: DataFrame) -> DataFrame:
    """Inside ``$$`` a line loses its first ``>`` and then one leading blank."""
    ctx = in_display(line_context(lines))
    cut = F.regexp_replace(F.regexp_replace("line", r"^(\s*)>", "$1"), "^ ", "")
    return _replaced(ctx, F.when(F.col("display") & F.col("bqi"), cut).otherwise(F.col("line")))


def single_empty_quote(lines: DataFrame) -> DataFrame:
    """Of a run of empty quote lines inside a labelled quote the first stays."""
    return numbered(empty_runs(line_context(lines)).where("not (empty and inside and nth > 1)"), F.array("line"))


def heading_separators(lines: DataFrame) -> DataFrame:
    """Separators right under a heading go, and of three or more line feeds in a row two stay."""
    ctx = line_context(lines)
    ctx = ctx.withColumn("rules", before(F.when(~F.col("blank") & ~F.col("dash"), F.col("head"))))
    return collapsed(numbered(ctx.where("not (dash and coalesce(rules, false))"), F.array("line")))


def display_without_blanks(lines: DataFrame) -> DataFrame:
    """Blank lines inside ``$$`` go."""
    return numbered(in_display(line_context(lines)).where("not (display and blank)"), F.array("line"))


def split_display(lines: DataFrame) -> DataFrame:
    """``$$ x $$`` on one line becomes three lines, inside a quote as well."""
    ctx = line_context(lines)
    plain, quote = _is("t", r"^\$\$.*\$\$$") & (F.length("t") > 4), _is("t", r"^> \$\$.*\$\$$") & (F.length("t") > 6)
    body = F.when(quote, strip(F.expr("substring(t, 5, length(t) - 6)"))).otherwise(strip(F.expr("substring(t, 3, length(t) - 4)")))
    return numbered(
        ctx,
        F.when(quote, F.array(F.lit("> $$"), F.concat(F.lit("> "), body), F.lit("> $$"))).when(plain, F.array(F.lit("$$"), body, F.lit("$$"))).otherwise(F.array("line")),
    )


def split_example_proof(lines: DataFrame) -> DataFrame:
    """An example and its proof on one quoted line become two, with an empty quote line between."""
    ctx = line_context(lines)
    same = F.startswith("t", F.lit("> **例")) & F.contains("t", F.lit("**证明"))
    at = F.locate("**证明", F.col("line"))
    first, second = F.regexp_replace(F.expr("substring(line, 1, locate('**证明', line) - 1)"), r"\s+$", ""), F.expr("concat('> ', substring(line, locate('**证明', line)))")
    return numbered(ctx, F.when(same & (at > 0), F.array(first, F.lit(">"), second)).otherwise(F.array("line")))


def broken_commands(lines: DataFrame) -> DataFrame:
    """``$$4pt]`` was a line break with a distance: two backslashes and ``[4pt]``."""
    return _replaced(lines, F.regexp_replace("line", r"\$\$(\d+pt\])", r"\\\\[$1"))


def collapsed(lines: DataFrame) -> DataFrame:
    """Of three or more line feeds in a row two stay: one blank line between lines, two at either end of a text."""
    rows = lines.withColumn("solid", F.sum((F.col("line") != "").cast("int")).over(rows_through()))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "solid").orderBy("line_no")))
    rows = rows.withColumn("ends", F.col("solid") == F.max("solid").over(Window.partitionBy("doc_id")))
    return numbered(rows.where((F.col("line") != "") | (F.col("nth") <= F.when(F.col("ends"), 3).otherwise(2))), F.array("line"))


def _pairs(ctx: DataFrame) -> DataFrame:
    """Adds ``lone`` and, for lines from an opening ``$$`` to its closing one, ``pair`` (its number)."""
    ctx = ctx.withColumn("lone", F.col("t") == "$$").withColumn("nth", F.sum(F.col("lone").cast("int")).over(rows_through()))
    ctx = ctx.withColumn("closes", after(F.when(F.col("lone"), True)).isNotNull())
    opened = (F.col("nth") % 2 == 1) & F.col("closes")
    return ctx.withColumn("pair", F.when(opened | (F.col("lone") & (F.col("nth") % 2 == 0)), F.ceil(F.col("nth") / 2)))


def wrapping_display(lines: DataFrame) -> DataFrame:
    """``$$`` pairs around headings, Chinese text or inline maths go; their content stays."""
    ctx = _pairs(line_context(lines))
    body = F.col("pair").isNotNull() & ~F.col("lone") & ~F.col("blank")
    block = Window.partitionBy("doc_id", "pair")
    has = lambda what: F.coalesce(F.max(F.when(body, what)).over(block), F.lit(False))
    first = F.min(F.when(body, F.struct("line_no", "line"))).over(block)["line"]
    ctx = ctx.withColumns({
        "inline": has(F.contains("line", F.lit("$"))), "display": has(F.contains("line", F.lit("\\begin{"))), "heading": has(_is("line", "^##? ")),
        "chinese": has(_is("line", "[\u4e00-\u9fff]")), "maths": F.coalesce(first.rlike(r"^\\[a-zA-Z]"), F.lit(False)),
    })
    wrong = F.col("heading") | (~F.col("display") & ((F.col("chinese") & (F.col("inline") | ~F.col("maths"))) | (F.col("inline") & ~F.col("maths"))))
    return numbered(ctx.where(~(F.col("lone") & F.col("pair").isNotNull() & wrong)), F.array("line"))


def display_dedented(lines: DataFrame) -> DataFrame:
    """An indented ``$$`` block moves left by its opening line's indentation."""
    ctx = _pairs(line_context(lines)).withColumn("lead", F.length("line") - F.length(F.ltrim("line")))
    indent = F.min(F.when(F.col("lone"), F.struct("line_no", "lead"))).over(Window.partitionBy("doc_id", "pair"))["lead"]
    ctx = ctx.withColumn("indent", indent)
    cut = F.expr("substring(line, least(indent, lead) + 1)")
    return _replaced(ctx, F.when(F.col("pair").isNotNull() & ~F.col("blank") & (F.col("indent") > 0), cut).otherwise(F.col("line")))


def example_proof_merged(lines: DataFrame) -> DataFrame:
    """Between an example and its proof blank lines go and other lines join the quote."""
    ctx = line_context(lines)
    stop = F.col("head") | _is("line", P.DASH) | _is("line", P.BARE_STATEMENT)
    event = F.when(_is("line", P.EXAMPLE_NUMBERED), "example").when(_is("line", P.PROOF), "proof").when(stop, "stop")
    ctx = ctx.withColumn("event", event)
    what = F.when(F.col("event").isNotNull(), F.struct("event", "line_no"))
    ctx = ctx.withColumns({"last": before(what), "next": after(what)})
    gap = F.col("event").isNull() & (F.col("last.event") == "example") & (F.col("next.event") == "proof") & (F.col("next.line_no") - F.col("last.line_no") < 25)
    ctx = ctx.withColumn("gap", F.coalesce(gap, F.lit(False)))
    quote = F.when(F.startswith("line", F.lit("> ")) | (F.col("line") == ">"), F.col("line")).otherwise(F.concat(F.lit("> "), "line"))
    return numbered(ctx.where("not (gap and blank)"), F.array(F.when(F.col("gap"), quote).otherwise(F.col("line"))))


def examples_wrapped(lines: DataFrame) -> DataFrame:
    """A top-level example and what follows up to the next item, heading or separator become one quote, with a blank line after it."""
    ctx = line_context(lines)
    opens, stops = _is("line", P.TOP_EXAMPLE), _is("line", r"^\s*---\s*$") | F.col("head") | _is("line", P.TOP_STOP)
    ctx = ctx.withColumns({"opens": opens, "stops": stops & ~opens})
    ctx = ctx.withColumn("inside", F.col("opens") | (~F.col("stops") & latch(F.col("opens"), F.col("stops"))))
    ctx = ctx.withColumn("part", F.sum((F.col("opens") | F.col("stops")).cast("int")).over(rows_through()))
    content = F.col("inside") & ~F.col("t").isin("", ">")
    ctx = ctx.withColumn("final", F.max(F.when(content, F.col("line_no"))).over(Window.partitionBy("doc_id", "part")))
    quote = F.when(~F.col("opens") & F.col("blank"), ">").when(~F.col("opens") & F.col("bq"), F.col("line")).otherwise(F.concat(F.lit("> "), "line"))
    ctx = ctx.where("not inside or line_no <= final")
    out = F.when(F.col("inside") & (F.col("line_no") == F.col("final")), F.array(quote, F.lit(""))).when(F.col("inside"), F.array(quote)).otherwise(F.array("line"))
    return collapsed(numbered(ctx, out))


def proof_steps(lines: DataFrame) -> DataFrame:
    """A one-line proof with at least two step words becomes a numbered list inside its quote."""
    head = r"^>\s+\*\*证明(思路|梗概|概要)\*\*[:：]\s*(.*)$"
    steps = F.split(F.regexp_extract("line", head, 2), rf"(?<=^|[:：；。\s])(?={P.STEP_WORDS})|(?<=^|[:：；。])(?={P.WEAK_STEP_WORDS})", -1)
    lines = lines.withColumn("steps", F.when(_is("line", head), steps))
    starts = F.regexp_extract("line", head, 2).rlike(rf"^(?:{P.STEP_WORDS}|{P.WEAK_STEP_WORDS})")
    marks = F.size("steps") - F.when(starts, 0).otherwise(1)
    kept = F.filter("steps", lambda x: strip(x) != "")
    made = F.concat(F.array(F.concat(F.lit("> **证明"), F.regexp_extract("line", head, 1), F.lit("**："))), F.transform(kept, lambda x, i: F.concat(F.lit("> "), (i + 1).cast("string"), F.lit(". "), strip(x))))
    return numbered(lines, F.when(F.col("steps").isNotNull() & (marks >= 2), made).otherwise(F.array("line")))


def images_quoted(lines: DataFrame) -> DataFrame:
    """An image line inside an open quote joins it."""
    ctx = line_context(lines)
    ctx = ctx.withColumn("open", latch(_is("line", P.QUOTE_HEAD), _is("line", P.QUOTE_END) & ~F.col("bqi")))
    return _replaced(ctx, F.when(F.col("open") & ~F.col("bqi") & _is("line", P.IMAGE), F.concat(F.lit("> "), F.ltrim("line"))).otherwise(F.col("line")))


REWRITERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        unwrap_struct, unwrap_statement, strip_unlabeled, add_quote, quote_blanks, add_separators, drop_dash_in_item, list_blank, separator_blanks_added,
        display_unquoted, single_empty_quote, heading_separators, display_without_blanks, split_display, split_example_proof, broken_commands, wrapping_display, display_dedented,
        example_proof_merged, examples_wrapped, proof_steps, images_quoted,
    )
}

#: H, G, I, J, K, L, M, N: the order matters and is not a fixed point.
CHAIN = ("unwrap_struct", "unwrap_statement", "strip_unlabeled", "add_quote", "quote_blanks", "add_separators", "drop_dash_in_item", "list_blank", "separator_blanks_added", "display_unquoted", "single_empty_quote")


def repaired(lines: DataFrame, steps: tuple[str, ...] = CHAIN) -> DataFrame:
    for step in steps:
        lines = REWRITERS[step](lines)
    return lines


def changes(before_: DataFrame, after_: DataFrame) -> DataFrame:
    """``doc_id, removed, added``: lines that only one of two line tables holds, as bags."""
    one = lambda rows, old, new: rows.select("doc_id", "line", F.lit(old).alias("old"), F.lit(new).alias("new"))
    both = one(before_, 1, 0).unionByName(one(after_, 0, 1)).groupBy("doc_id", "line").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    return both.groupBy("doc_id").agg(F.sum(F.greatest(F.col("old") - F.col("new"), F.lit(0))).alias("removed"), F.sum(F.greatest(F.col("new") - F.col("old"), F.lit(0))).alias("added"))
