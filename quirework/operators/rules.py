"""Structure rules: each takes ``line_context`` and returns findings ``doc_id, line_no, ...``.

Rules are registered with a code, a severity and their order; ``findings`` unions the enabled ones, ``gate`` decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import matched, roman_to_int, strip
from ..plans.lines import after, before, count_before, forward, is_quoted, latch, rows_through

BLOCKS, WARNS = "blocks", "warns"


@dataclass(frozen=True)
class Rule:
    code: str
    name: str
    find: Callable[[DataFrame], DataFrame]
    severity: str = BLOCKS
    #: For rules that judge a line by its context alone: all of them are answered in one pass.
    flag: Callable[[], Column] | None = None


RULES: dict[str, Rule] = {}


def rule(code: str, severity: str = BLOCKS) -> Callable:
    """Registers a rule; a name may be used once."""

    def add(find: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        if find.__name__ in RULES:
            raise ValueError(f"two rules are named {find.__name__}")
        RULES[find.__name__] = Rule(code, find.__name__, find, severity)
        return find

    return add


def flagged(flag: Callable[[], Column], prepare: Callable[[DataFrame], DataFrame] = lambda ctx: ctx) -> Callable[[DataFrame], DataFrame]:
    """The rule ``ctx -> doc_id, line_no`` of a column that tells which lines are meant."""

    @wraps(flag)
    def find(ctx: DataFrame) -> DataFrame:
        return prepare(ctx).select("doc_id", "line_no", flag().alias("meant")).where("meant").select("doc_id", "line_no")

    return find


def line_rule(code: str, severity: str = BLOCKS) -> Callable:
    """Registers a rule given as a column over ``line_context``."""

    def add(flag: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
        find = rule(code, severity)(flagged(flag))
        RULES[flag.__name__] = Rule(code, flag.__name__, find, severity, flag)
        return find

    return add


def met(ctx: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``doc_id, code, rule, severity, line_no`` of line rules, all in one pass over the lines."""
    hits = [F.when(r.flag(), F.struct(F.lit(r.code).alias("code"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"))) for r in rules]
    rows = ctx.select("doc_id", "line_no", F.array_compact(F.array(*hits)).alias("hits")).where("size(hits) > 0")
    return rows.select("doc_id", "line_no", F.explode("hits").alias("hit")).select("doc_id", "hit.code", "hit.rule", "hit.severity", "line_no")


def _is(column: str, pattern: str) -> Column:
    return F.coalesce(matched(F.col(column), pattern), F.lit(False))


def _where(ctx: DataFrame, what: Column) -> DataFrame:
    return ctx.where(what).select("doc_id", "line_no")


@line_rule("G")
def quote_continuity() -> Column:
    """A bare blank line inside a proof or example quote whose next line is content."""
    off = (_is("line", P.QUOTE_END) & ~F.col("bqi")) | (~F.col("blank") & ~F.col("bq"))
    inside = latch(_is("line", P.QUOTE_HEAD), off)
    ends = _is("nnb", P.QUOTE_HEAD) | (_is("nnb", P.QUOTE_END) & ~is_quoted("nnb"))
    return F.col("blank") & ~F.col("bq") & inside & F.col("nnb").isNotNull() & ~ends


@line_rule("G")
def nested_quote() -> Column:
    return _is("line", P.NESTED_QUOTE)


@line_rule("G")
def same_line_proof() -> Column:
    """An example and its proof on one line."""
    return F.startswith("t", F.lit("> **例")) & F.contains("t", F.lit("**证明"))


def _example_gap(ctx: DataFrame, example: str) -> DataFrame:
    stop = _is("line", example) | F.col("head") | _is("line", P.DASH) | _is("line", P.BARE_STATEMENT)
    bad = F.col("blank") | ~F.col("bq")
    ctx = ctx.withColumn("stops", count_before(stop)).withColumn("own", stop.cast("int"))
    ctx = ctx.withColumns({
        "proof": after(F.when(_is("line", P.PROOF), F.struct("line_no", "stops"))),
        "first_bad": after(F.when(bad, F.col("line_no"))),
    })
    near = (F.col("proof.line_no") < F.col("line_no") + 25) & (F.col("proof.stops") == F.col("stops") + F.col("own"))
    found = ctx.where(_is("line", example) & near & (F.col("first_bad") < F.col("proof.line_no")))
    return found.select("doc_id", "line_no", F.col("first_bad").alias("gap_line"), F.col("proof.line_no").alias("proof_line"))


@rule("G")
def example_proof_gap(ctx: DataFrame) -> DataFrame:
    """A blank or unquoted line between an example and the proof that follows within 24 lines."""
    return _example_gap(ctx, P.EXAMPLE)


@rule("G", WARNS)
def numbered_example_proof_gap(ctx: DataFrame) -> DataFrame:
    """The same for examples whose label carries a number."""
    return _example_gap(ctx, P.EXAMPLE_NUMBERED)


@line_rule("H")
def struct_in_quote() -> Column:
    """A statement label inside a quote, unless it heads a proof of that statement."""
    return _is("line", P.QUOTED_STATEMENT) & ~_is("line", P.QUOTED_PROOF_OF)


@line_rule("H")
def orphan_quote() -> Column:
    return _is("line", P.EMPTY_QUOTE) & ~is_quoted("pnb") & ~is_quoted("nnb")


@line_rule("H")
def stmt_in_quote() -> Column:
    """Statement content in a quote between a statement's head and its first proper quote."""
    return latch(_is("line", P.STATEMENT_OR_FORMULA), _is("line", P.QUOTE_LEGIT)) & _is("line", P.QUOTE_WRAPPED)


def quote_groups(ctx: DataFrame, every: bool = False) -> DataFrame:
    """Quoted lines with ``quote`` (number of their group) and ``decides`` (the group's first line with content); ``every``: all lines."""
    opener = _is("line", P.QUOTE_OPENER) | _is("line", P.QUOTE_FOOTNOTE)
    starts = F.col("bqi") & (~is_quoted("p1") | opener)
    ctx = ctx.withColumn("quote", F.sum(starts.cast("int")).over(rows_through()))
    content = F.when(F.col("bqi") & (F.regexp_replace("line", r"^\s+", "") != ">"), F.struct("line_no", "line"))
    return (ctx if every else ctx.where("bqi")).withColumn("decides", F.min(content).over(Window.partitionBy("doc_id", "quote"))["line"])


@rule("H")
def unlabeled_quote(ctx: DataFrame) -> DataFrame:
    """Content of quotes that no proof, example or note opens."""
    fine = _is("decides", P.QUOTE_OPENER) | _is("decides", P.QUOTE_FOOTNOTE) | _is("decides", P.QUOTED_STATEMENT_CN)
    return _where(quote_groups(ctx), F.col("decides").isNotNull() & ~fine & (F.col("t") != ">"))


@line_rule("H")
def missing_quote() -> Column:
    return ~F.col("bqi") & ~F.col("head") & (_is("t", P.QUOTE_MISSING) | _is("t", P.FOOTNOTE))


def item_pairs(ctx: DataFrame) -> DataFrame:
    """Items at most 100 lines before the next one without separator or heading between: ``doc_id, line_no, next_line``."""
    item, stop = _is("line", P.STATEMENT) | _is("line", P.ITEM_EXAMPLE), F.col("dash") | F.col("head")
    ctx = ctx.withColumn("stops", count_before(stop)).withColumn("follows", after(F.when(item, F.struct("line_no", "stops"))))
    near = (F.col("follows.line_no") - F.col("line_no") <= 100) & (F.col("follows.stops") == F.col("stops"))
    return ctx.where(item & near).select("doc_id", "line_no", F.col("follows.line_no").alias("next_line"))


def follows_item(ctx: DataFrame) -> DataFrame:
    """Adds ``second``: whether a line is the later one of such a pair."""
    item, stop = _is("line", P.STATEMENT) | _is("line", P.ITEM_EXAMPLE), F.col("dash") | F.col("head")
    ctx = ctx.withColumn("stops", count_before(stop)).withColumn("was", before(F.when(item, F.struct("line_no", "stops"))))
    near = (F.col("line_no") - F.col("was.line_no") <= 100) & (F.col("was.stops") == F.col("stops"))
    return ctx.withColumn("second", F.coalesce(item & near, F.lit(False)))


@rule("I")
def missing_separator(ctx: DataFrame) -> DataFrame:
    return item_pairs(ctx)


def dash_before_point() -> Column:
    """A separator inside an item, right before a numbered point."""
    inside = latch(_is("line", P.STATEMENT_OR_FORMULA) | _is("line", P.SUBPOINT), F.col("bqi") | F.col("head"))
    return _is("line", P.DASH) & inside & _is("nnb", P.SUBPOINT)


def dash_inside(ctx: DataFrame) -> DataFrame:
    """Adds ``wrong``: a separator as ``dash_before_point`` finds it."""
    return ctx.withColumn("wrong", dash_before_point())


@line_rule("J")
def dash_in_item() -> Column:
    return dash_before_point()


def proof_after_list_line() -> Column:
    return _is("line", P.LISTED) & F.coalesce(F.startswith(strip(F.col("n1")), F.lit("> **证明")), F.lit(False))


@line_rule("K")
def proof_after_list() -> Column:
    return proof_after_list_line()


def tight(column: str) -> Column:
    """Whether the neighbouring line is there and not blank."""
    return F.coalesce(strip(F.col(column)) != "", F.lit(False))


@rule("L")
def separator_blanks(ctx: DataFrame) -> DataFrame:
    """A separator without a blank line before or after it: one finding a side."""
    sides = F.filter(F.array(F.when(tight("p1"), F.lit("before")), F.when(tight("n1"), F.lit("after"))), lambda x: x.isNotNull())
    return ctx.where("dash").select("doc_id", "line_no", F.explode(sides).alias("side"))


def displayed() -> Column:
    """Whether a line is between an odd ``$$`` line and a later one."""
    fence = F.col("t") == "$$"
    return ~fence & (count_before(fence) % 2 == 1) & after(F.when(fence, True)).isNotNull()


def in_display(ctx: DataFrame) -> DataFrame:
    """Adds ``display``."""
    return ctx.withColumn("display", displayed())


@line_rule("M")
def displaymath_gt() -> Column:
    return displayed() & F.col("bqi")


def empty_runs(ctx: DataFrame) -> DataFrame:
    """Empty quote lines inside a labelled quote, with ``run`` (the run's number) and ``nth`` (the place in it)."""
    on = F.startswith("t", F.lit("> **")) & (F.contains("t", F.lit("证明")) | F.contains("t", F.lit("例")) | F.contains("t", F.lit("注")))
    off = _is("t", P.DASH) | _is("t", P.HEADING) | _is("t", P.STATEMENT_CN)
    ctx = ctx.withColumn("inside", latch(on, off)).withColumn("empty", F.col("t") == ">")
    starts = F.col("empty") & ~F.coalesce(F.lag("empty").over(forward()), F.lit(False))
    ctx = ctx.withColumn("run", F.when(F.col("empty"), F.sum(starts.cast("int")).over(rows_through())))
    return ctx.withColumn("nth", F.when(F.col("empty"), F.row_number().over(Window.partitionBy("doc_id", "run").orderBy("line_no"))))


@rule("N")
def empty_quote_runs(ctx: DataFrame) -> DataFrame:
    runs = empty_runs(ctx).where("empty and inside").groupBy("doc_id", "run").agg(F.min("line_no").alias("line_no"), F.max("line_no").alias("last_line"), F.count("*").alias("n"))
    return runs.where("n > 1").select("doc_id", "line_no", "last_line")


def ordinal_label(line: str, is_quote: Column) -> Column:
    """``(3)``, ``**3.**`` or ``3. x`` -> ``3``; letters alike; null if the line has no ordinal."""
    said = [F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in (P.ORDINAL_PAREN, P.ORDINAL_BOLD, P.ORDINAL_PLAIN)]
    return F.coalesce(said[0], said[1], F.when(~is_quote, said[2]))


def ordinal_blocks(rows: DataFrame, gap: int = 4, least: int = 3) -> DataFrame:
    """``doc_id, line_no, label`` -> blocks of ordinals at most ``gap`` lines apart and their numbers.

    Labels of digits count as numbers, roman numerals and letters by their value; a longer label that is neither
    has no ordinal.
    """
    starts = F.coalesce(F.col("line_no") - F.lag("line_no").over(forward()) > gap, F.lit(True))
    rows = rows.withColumn("block", F.sum(starts.cast("int")).over(rows_through()))
    digit, long = F.col("label").rlike("^[0-9]+$"), F.length("label") > 1
    kinds = rows.groupBy("doc_id", "block").agg(
        F.count("*").alias("n"),
        F.every(digit).alias("digits"),
        F.every(~digit).alias("letters"),
        F.coalesce(F.bool_and(F.when(long, F.col("label").rlike(P.ROMAN))), F.every(F.col("label").rlike("^[ivxlcdm]$"))).alias("romans"),
        F.collect_list(F.struct("line_no", "label")).alias("rows"),
    )
    kind = F.when(F.col("digits"), "numeric").when(F.col("letters") & F.col("romans"), "roman").when(F.col("letters"), "alpha").otherwise("numeric")
    rows = kinds.where(F.col("n") >= least).select("doc_id", "block", kind.alias("kind"), F.explode("rows").alias("r")).select("doc_id", "block", "kind", "r.*")
    value = (
        F.when(F.col("kind") == "roman", roman_to_int(F.col("label")))
        .when(F.col("kind") == "alpha", F.when(F.length("label") == 1, F.ascii("label") - 96))
        .otherwise(F.when(digit, F.col("label").try_cast("long")).otherwise(0))
    )
    rows = rows.withColumn("value", value.cast("long")).where("value > 0")
    return rows.groupBy("doc_id", "block", "kind").agg(
        F.count("*").alias("n"), F.min("line_no").alias("line_no"), F.min("value").alias("low"), F.max("value").alias("high"), F.countDistinct("value").alias("held")
    ).where(F.col("n") >= least)


@rule("O")
def ordinal_gaps(ctx: DataFrame) -> DataFrame:
    """Ordinal sequences that begin above 1 (``head``) or have holes (``internal``), with how many are missing."""
    rows = ctx.withColumn("label", ordinal_label("line", F.col("bqi"))).where("label is not null").select("doc_id", "line_no", "label")
    gaps = F.array(
        F.struct(F.lit("head").alias("gap"), (F.col("low") - 1).alias("missing")),
        F.struct(F.lit("internal").alias("gap"), (F.col("high") - F.col("low") + 1 - F.col("held")).alias("missing")),
    )
    return ordinal_blocks(rows).select("doc_id", "line_no", "kind", F.explode(gaps).alias("g")).select("doc_id", "line_no", "kind", "g.gap", "g.missing").where("missing > 0")


@line_rule("Q", WARNS)
def dash_under_heading() -> Column:
    """A separator whose last non-blank line before is a heading."""
    return F.col("dash") & _is("pnb", P.HEADING)


@line_rule("S", WARNS)
def dash_before_proof() -> Column:
    """A separator between a statement and its proof."""
    return F.col("dash") & latch(_is("line", P.STATEMENT), F.col("head")) & ~_is("pnb", P.HEADING) & F.coalesce(F.startswith("nnb", F.lit("> **证明")), F.lit(False))


@line_rule("S", WARNS)
def item_as_heading() -> Column:
    """Statements must not be headings, and section headings carry their sign."""
    return _is("line", rf"^#{{1,6}}\s+\*{{0,2}}(?:{P.LABELS}|{P.LABELS_EN})") | (_is("line", r"^##\s") & ~_is("line", r"^##\s+§"))


@line_rule("S", WARNS)
def mojibake() -> Column:
    return _is("line", P.MOJIBAKE)


@line_rule("S", WARNS)
def bracket_display() -> Column:
    """Display maths in backslash brackets instead of ``$$``."""
    return _is("line", r"\\[\[\]]")


def findings(ctx: DataFrame, disabled: Iterable[str] = ()) -> DataFrame:
    """``doc_id, code, rule, severity, line_no`` of every rule whose code is not disabled: line rules in one pass, the others beside it."""
    on = [r for r in RULES.values() if r.code not in set(disabled)]
    parts = [met(ctx, [r for r in on if r.flag])] if any(r.flag for r in on) else []
    parts += [r.find(ctx).select("doc_id", F.lit(r.code).alias("code"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), "line_no") for r in on if not r.flag]
    return reduce(DataFrame.unionByName, parts)


def gate(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """``doc_id, n_blocking, n_warning, passed`` for every document, of the counts of ``all_layers``."""
    total = lambda severity: F.coalesce(F.sum(F.when(F.col("severity") == severity, F.col("n"))), F.lit(0))
    counts = counted.groupBy("doc_id").agg(total(BLOCKS).alias("n_blocking"), total(WARNS).alias("n_warning"))
    out = docs.select("doc_id").join(counts, "doc_id", "left").na.fill(0, ["n_blocking", "n_warning"])
    return out.withColumn("passed", F.col("n_blocking") == 0)


def gate_pivot(found: DataFrame) -> DataFrame:
    """One row a document with findings, one count a rule; the columns are known from the registry."""
    return found.groupBy("doc_id").pivot("rule", sorted(RULES)).count().na.fill(0)


def all_layers(**layers: DataFrame) -> DataFrame:
    """``doc_id, layer, rule, severity, n``: findings ``doc_id, rule, severity`` of several layers, counted."""
    parts = [rows.select("doc_id", F.lit(layer).alias("layer"), "rule", "severity") for layer, rows in layers.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "layer", "rule", "severity").agg(F.count("*").alias("n"))


def report(counted: DataFrame) -> DataFrame:
    """``doc_id, passed, text``: one line a rule, what blocks first, by layer; a document passes if nothing blocks."""
    line = F.concat(F.when(F.col("severity") == "blocks", "FAIL ").otherwise("warn "), "layer", F.lit(" "), "rule", F.lit(": "), F.col("n").cast("string"))
    order = F.array_sort(F.collect_list(F.struct((F.col("severity") != "blocks").alias("mild"), "layer", "rule", line.alias("line"))))
    return counted.groupBy("doc_id").agg((F.count_if(F.col("severity") == "blocks") == 0).alias("passed"), F.array_join(order["line"], "\n").alias("text"))
