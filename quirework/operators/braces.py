"""Brace repair inside maths, and repairs that are repeated until nothing changes.

The maths mode of a text follows from its dollar signs alone: a window over them cuts a document into segments, each
with one mode, in which braces start afresh. Only braces move the state of a segment (how many groups are open, and
whether an escaped brace waits for its partner), so a segment is cut at its braces, each brace is told what stands before
and after it, and one fold over the braces decides which of them gain or lose their backslash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import matched, strip
from ..plans.lines import before, dealt, forward, md_lines, parted, rows_before, shares
from ..plans.stored import stored
from . import maths

# Fixed values of the document format: commands that take a group, and how far back one is looked for.
GROUP_COMMANDS = (
    "mathcal|operatorname|mathbf|mathrm|mathbb|mathscr|mathsf|mathtt|frac|binom|stackrel|begin|end|tilde|hat|dot|ddot|bar|vec|overline|widetilde|widehat"
    "|text|textnormal|textbf|textit|boxed|cases|array|matrix"
)
BEHIND, DEEP = 20, 2

_MARK = "\x01"


def texts(lines: DataFrame) -> DataFrame:
    """``doc_id, text`` of a line table."""
    return lines.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("line_no", "line")))["line"], "\n").alias("text"))


def segments(docs: DataFrame) -> DataFrame:
    """``doc_id, segment, fence, maths, body``: the text cut at the dollar signs that switch maths on or off.

    ``$$`` always switches display maths; a single ``$`` switches inline maths outside it and is a character inside;
    the end of display maths ends inline maths too. ``fence`` is the sign that the segment begins with.
    """
    parts = docs.select("doc_id", F.posexplode_outer(F.regexp_extract_all("text", F.lit(r"[^$]+|\$\$|\$"), F.lit(0))).alias("pos", "part"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    through = order.rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("display", F.coalesce(F.sum((F.col("part") == "$$").cast("int")).over(through), F.lit(0)))
    parts = parts.withColumn("switch", (F.col("part") == "$") & (F.col("display") % 2 == 0))
    inline = F.sum(F.col("switch").cast("int")).over(Window.partitionBy("doc_id", "display").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    fence = F.coalesce((F.col("part") == "$$") | F.col("switch"), F.lit(False))
    parts = parts.withColumns({"maths": (F.col("display") % 2 == 1) | (F.coalesce(inline, F.lit(0)) % 2 == 1), "fence": fence})
    parts = parts.withColumn("segment", F.sum(F.col("fence").cast("int")).over(through))
    body = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("fence"), F.struct("pos", "part"))))["part"], "")
    return parts.groupBy("doc_id", "segment").agg(F.coalesce(F.max(F.when(F.col("fence"), F.col("part"))), F.lit("")).alias("fence"), F.max("maths").alias("maths"), body.alias("body"))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row, however many elements of another one's lambda read it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _said(i: Column) -> Column:
    """What the fold needs to know of the brace at ``i`` of ``cut`` (texts and braces by turns), as one letter.

    ``o c`` plain braces; of escaped closing ones ``x`` if a plain one follows at once, else ``y``; of escaped opening
    ones ``a`` after a script sign or a command with a group, ``d`` after a closing brace, else ``n``.
    """
    brace, gap = F.get("cut", i), F.get("cut", i - 1)
    behind = F.regexp_replace(F.substring(gap, -BEHIND, BEHIND), r"\s+$", "")
    touches = (behind == "") & (F.length(gap) < BEHIND) & (i > 1) & F.endswith(F.get("cut", i - 2), F.lit("}"))
    group = behind.rlike("[_^]$") | behind.rlike(rf"\\(?:{GROUP_COMMANDS})$")
    opening = F.when(group, "a").when(touches, "d").otherwise("n")
    closing = F.when((F.get("cut", i + 1) == "") & (F.get("cut", i + 2) == "}"), "x").otherwise("y")
    return F.when(brace == "{", "o").when(brace == "}", "c").when(brace == "\\{", opening).otherwise(closing)


def _decided(kinds: Column) -> Column:
    """For each brace ``k`` (as it is), ``u`` (loses its backslash) or ``e`` (gains one)."""

    def step(acc: Column, kind: Column) -> Column:
        depth, waits = acc["depth"], acc["waits"]
        unescaped = (kind == "a") | ((kind == "d") & (depth <= DEEP))
        down = ((kind == "c") | (kind == "y")) & (depth > 0)
        said = F.when(unescaped | ((kind == "y") & (depth > 0)), "u").when((kind == "c") & (depth == 0) & waits, "e").otherwise("k")
        now = depth + F.when(unescaped | (kind == "o"), 1).when(down, -1).otherwise(0)
        opens = kind.isin("a", "d", "n") & ~unescaped
        closed = (depth == 0) & kind.isin("c", "x", "y")
        return F.struct(now.alias("depth"), (opens | (waits & ~closed)).alias("waits"), F.concat(acc["said"], said).alias("said"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("waits"), F.lit("").alias("said"))
    return F.aggregate(kinds, start, step, lambda acc: F.split(acc["said"], ""))


def braces(lines: DataFrame) -> DataFrame:
    """Braces of maths whose backslash is wrong: groups of scripts and commands lose it, a set that a plain brace closes gains it."""
    parts = segments(texts(lines))
    broken = F.col("maths") & F.col("body").rlike(r"\\[{}]")
    fixed = parts.where(broken).withColumn("body", F.translate("body", _MARK, "\x02"))
    fixed = _once(fixed, "cut", F.split(F.regexp_replace("body", r"(\\?[{}])", f"{_MARK}$1{_MARK}"), _MARK, -1))
    fixed = _once(fixed, "kinds", F.transform(F.sequence(F.lit(1), F.size("cut") - 2, F.lit(2)), _said))
    fixed = _once(fixed, "said", _decided(F.col("kinds")))

    def written(x: Column, i: Column) -> Column:
        said = F.get("said", F.floor(i / 2).cast("int"))
        return F.when(i % 2 == 0, x).when(said == "u", F.substring(x, 2, 1)).when(said == "e", F.concat(F.lit("\\"), x)).otherwise(x)

    fixed = fixed.withColumn("body", F.array_join(F.transform("cut", written), "")).select(parts.columns)
    every = parts.where(~broken).unionByName(fixed)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "fence", "body"))), lambda s: F.concat(s["fence"], s["body"])), "")
    return md_lines(every.groupBy("doc_id").agg(whole.alias("text")))


# --- edits of maths lines by priority, and the fixed point


def _near(line: Column) -> Column:
    """A short text that stands for a line in the rules of its neighbours: these ask whether it is blank, quoted, a fence or a bullet."""
    t = F.col("t")
    return (
        F.when(t.isin("", ">", "$$"), t)
        .when(F.startswith(t, F.lit("> ")), "> x")
        .when(F.startswith(t, F.lit(">")), ">x")
        .when(matched(line, P.BULLET), "- (i)")
        .otherwise("x")
    )


#: Edits that a line calls for whatever stands around it, by priority; the last one gives way to a block that fell out of its quote.
_ALONE = ("escaped_display", "nested_display", "deep_quoted_display", "one_line_display", "attached_display", "bare_struct_in_quote")


def edited(lines: DataFrame) -> DataFrame:
    """Every line's maths edits in one pass, by priority: escaped signs first, then what replaces the line, then blanks around it.

    Of the replacements one applies: a nested quote becomes one level, over-indented signs move left, a formula on the
    line of its signs gets lines of its own, a block that fell out of a quote joins it again. ``touched`` tells the lines
    that are not as they were; further columns of a line go with it. What a line calls for by itself is worked out before
    the windows, which see short texts in place of the lines around; lines are sorted once and counted, not numbered by a second sort.
    """
    more = [c for c in lines.columns if c not in ("doc_id", "line_no", "line", "touched")]
    ctx = lines.withColumn("t", strip(F.col("line")))
    alone = reduce(lambda rest, name: F.when(maths.MATHS_LINES[name](), name).otherwise(rest), reversed(_ALONE), F.lit(""))
    said = F.when(F.col("t").isin("$$", "</div>"), F.col("t")).when(F.startswith("t", F.lit("> $$")), "> $$").when(F.startswith("t", F.lit("<div")), "<div").otherwise("x")
    ctx = ctx.select("doc_id", "line_no", "line", *more, "t", alone.alias("alone"), _near(F.col("line")).alias("near"), matched(F.col("line"), P.TOP_ITEM).alias("top"), said.alias("said"))
    # One step a column: `strip` writes its argument several times, and code that grows beyond a limit of the JVM is never compiled.
    ctx = ctx.withColumn("core", F.when(F.col("alone").isin("one_line_display", "attached_display"), F.regexp_replace("t", r"^>\s*", "")))
    ctx = ctx.withColumn("core", strip(F.col("core")))
    ctx = ctx.withColumn("body", F.regexp_replace("core", r"^\$\$|\$\$$", "")).withColumn("body", strip(F.col("body")))
    ctx = ctx.select("doc_id", "line_no", "line", *more, "alone", "near", "top", F.startswith("t", F.lit(">")).alias("quote"), F.startswith("core", F.lit("$$")).alias("first"), "body", F.col("said").alias("t"))
    lone = F.col("t") == "$$"
    every = forward().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ctx = ctx.withColumns({
        "p1": F.lag("near").over(forward()),
        "n1": F.lead("near").over(forward()),
        "pnb": before(F.when(F.col("near") != "", F.col("near"))),
        "later": F.max(F.when(lone, F.col("line_no"))).over(every) > F.col("line_no"),
    })
    ctx = maths.display_state(ctx)
    flag = {name: maths.MATHS_LINES[name]() for name in ("div_blanks", "display_needs_blank", "escaped_from_quote")}
    gap = F.col("top") & F.coalesce(matched(F.col("p1"), P.BULLET), F.lit(False))
    ctx = ctx.withColumns({f"f_{name}": column for name, column in flag.items()} | {"f_list_gap": gap})
    on = lambda name: F.col("alone") == name if name in _ALONE else F.col(f"f_{name}")
    mark, body = F.when(F.col("quote"), "> ").otherwise(""), F.col("body")
    fence = F.concat(mark, F.lit("$$"))
    new = (
        F.when(on("escaped_display"), F.array(F.regexp_replace("line", r"\\\$\\\$", r"\$\$")))
        .when(on("nested_display"), F.array(F.regexp_replace("line", r"^\s*>\s+>\s*", "> ")))
        .when(on("deep_quoted_display"), F.array(F.regexp_replace("line", r"^(\s*>)\s{2,}", "$1 ")))
        .when(on("one_line_display"), F.array(fence, F.concat(mark, body), fence))
        .when(on("attached_display"), F.when(F.col("first"), F.array(fence, F.concat(mark, body))).otherwise(F.array(F.concat(mark, body), fence)))
        .when(on("escaped_from_quote"), F.array(F.concat(F.lit("> "), "line")))
        .when(on("bare_struct_in_quote"), F.array(F.regexp_replace("line", r"^>\s+", "")))
        .otherwise(F.array("line"))
    )
    none, blank = F.array().cast("array<string>"), F.array(F.when(F.col("f_display_needs_blank") & F.col("quoted_fence"), ">").otherwise(""))
    above = on("display_needs_blank") | on("list_gap") | (on("div_blanks") & F.startswith("t", F.lit("<div")))
    below = on("div_blanks") & (F.col("t") == "</div>")
    ctx = ctx.select("doc_id", "line_no", "line", *more, "alone", "quote", "first", "body", "quoted_fence", "f_display_needs_blank", "f_escaped_from_quote", above.alias("above"), below.alias("below"))
    out = F.concat(F.when(F.col("above"), blank).otherwise(none), new, F.when(F.col("below"), F.array(F.lit(""))).otherwise(none))
    ctx = ctx.withColumn("out", out).withColumns({"n": F.size("out"), "touched": F.col("out") != F.array("line")}).drop("out")
    ctx = ctx.withColumn("start", F.coalesce(F.sum("n").over(rows_before()), F.lit(0)))
    rows = ctx.select("doc_id", "start", *more, "touched", F.posexplode(out).alias("pos", "line"))
    return rows.select("doc_id", (F.col("start") + F.col("pos") + 1).cast("int").alias("line_no"), "line", *more, "touched")


def digests(lines: DataFrame) -> DataFrame:
    """``doc_id, digest`` of a document's lines and their order."""
    return lines.groupBy("doc_id").agg(F.struct(F.count("*"), F.sum(F.xxhash64("line_no", "line").cast("decimal(38,0)")), F.sum(F.xxhash64("line", "line_no").cast("decimal(38,0)"))).alias("digest"))


#: Rounds of a step that tells what it touched are run in one go, without a table between them.
TOGETHER = 3


def settled(lines: DataFrame, step: Callable[[DataFrame], DataFrame], most: int = 12) -> tuple[DataFrame, DataFrame]:
    """``step`` repeated until no document changes -> (lines, ``doc_id, rounds``: the rounds that changed it).

    Only documents that the last round changed go on; the others are done. Raises if some still change after ``most``
    rounds, for then the step has no fixed point on them. A step whose rows say whether they are ``touched`` is run
    ``TOGETHER`` times between two tables: on a document that is done it changes nothing. Any other step is run once, and
    digests of its documents are compared.
    """
    active, done, rounds, ran = lines, [], [], 0
    while ran <= most:
        now, took = active, 0
        while took < min(TOGETHER, most + 1 - ran):
            now, took = step(parted(now) if took else now), took + 1
            if "touched" not in now.columns:
                break
            now = now.withColumnRenamed("touched", f"touched_{took}")
        told = f"touched_{took}" in now.columns
        if told:
            after = stored(now, "round")
            changed = after.where(f"touched_{took}").select("doc_id").distinct()
        else:
            active = stored(active, "active")
            after = stored(step(active), "round")
            was, now = digests(active).withColumnRenamed("digest", "was"), digests(after)
            changed = was.join(now, was["doc_id"].eqNullSafe(now["doc_id"])).where("was <> digest").select(was["doc_id"])
        changed = stored(changed, "changed")
        last = F.max(F.greatest(F.lit(0), *[F.when(F.col(f"touched_{k}"), F.lit(k)) for k in range(1, took + 1)])) if told else F.lit(0)
        count = after.groupBy("doc_id").agg((F.lit(ran) + last).cast("int").alias("rounds"))
        after, ran = after.select("doc_id", "line_no", "line"), ran + took
        if changed.isEmpty():
            return reduce(DataFrame.unionByName, [*done, after]), reduce(DataFrame.unionByName, [*rounds, count])
        # Ids may be null; a join by name would take these as done.
        which = changed.withColumnRenamed("doc_id", "id")
        same = F.col("doc_id").eqNullSafe(F.col("id"))
        done.append(after.join(which, same, "left_anti"))
        rounds.append(count.join(which, same, "left_anti"))
        active = dealt(after.join(which, same, "left_semi"), text="line")
    raise ValueError(f"{changed.count()} documents still change after {most} rounds")


def fired(lines: DataFrame, steps: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Runs steps one after the other -> (lines, ``doc_id, step``: which steps changed which documents)."""
    now, told = stored(lines, "before"), []
    tasks = shares(now, "line")
    for name, step in steps.items():
        after = stored(step(now.repartition(tasks, "doc_id") if tasks else now), name)
        both = digests(now).withColumnRenamed("digest", "was").join(digests(after), "doc_id")
        told.append(both.where("was <> digest").select("doc_id", F.lit(name).alias("step")))
        now = after
    return now, reduce(DataFrame.unionByName, told)


