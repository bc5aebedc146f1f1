"""Formulas of a summary against those of its source: bags of symbols, matched by a bounded similarity join.

A formula is the bag of its symbols (commands, letters, digits, signs) after noise of the scan is taken out. Copies of a
symbol are numbered, which makes the bag a set, and similarity is Jaccard's of two sets. Symbols that are likely rare come first in
each set; two sets that are similar enough share one of their first few, so only such pairs meet, within a document.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stored import stored

# Commands that only change type or spacing, and spellings of one symbol.
NOISE = r"\\(?:pmb|boldsymbol|bf|rm|it|mathrm|mathbf|mathit|mathscr|mathcal|mathbb|displaystyle|textstyle|left|right|limits|nolimits|quad|qquad|hspace|vspace|[,;:! ])"
SAME = {"\\varnothing": "\\emptyset", "\\leqslant": "\\leq", "\\le": "\\leq", "\\geqslant": "\\geq", "\\ge": "\\geq", "\\to": "\\rightarrow", "\\ne": "\\neq", "\\lbrace": "\\{", "\\rbrace": "\\}"}
SYMBOL = r"\\[A-Za-z]+|\\.|[^\s{}$\\]"
#: Similarity from which a formula of the source counts as the one meant.
LEAST = Fraction(3, 5)


def symbols(latex: Column) -> Column:
    """The symbols of a formula in order, without noise, braces and blanks, each in one spelling."""
    plain = F.regexp_replace(F.coalesce(latex, F.lit("")), rf"{NOISE}(?=[^A-Za-z]|$)", " ")
    found = F.regexp_extract_all(plain, F.lit(SYMBOL), F.lit(0))
    spelling = F.create_map(*[F.lit(x) for pair in SAME.items() for x in pair])
    return F.transform(found, lambda s: F.coalesce(F.element_at(spelling, s), s))


def _bags(formulas: DataFrame) -> DataFrame:
    """``doc_id, id, size, elements``: the symbols of each formula, copies numbered; one without symbols is none."""
    rows = formulas.select("doc_id", "id", F.explode(F.array(F.array_sort(symbols(F.col("latex"))))).alias("s")).where("size(s) > 0")
    # Equal symbols stand together once they are sorted: the number of a copy is its place since the first of them.
    copies = F.transform("s", lambda x, i: F.struct(x.alias("symbol"), (i + 2 - F.array_position("s", x)).cast("int").alias("copy")))
    return rows.select("doc_id", "id", F.size("s").alias("size"), copies.alias("elements"))


def _firsts(bags: DataFrame, least: Fraction) -> DataFrame:
    """``doc_id, id, size, h``: hashes of the first elements of each set; second copies and long symbols come first, as they are rare.

    Any order that all sets share finds all pairs; one that follows from the element alone needs no counts of the table.
    """
    order = F.array_sort(F.transform("elements", lambda e: F.struct((-e["copy"]).alias("c"), (-F.length(e["symbol"])).alias("n"), e["symbol"].alias("symbol"))))
    most = F.col("size") - F.ceil(F.col("size") * least.numerator / least.denominator) + 1
    return bags.select("doc_id", "id", "size", F.explode(F.transform(F.slice(order, F.lit(1), most.cast("int")), lambda e: F.xxhash64(e["c"], e["symbol"]))).alias("h"))


def drift(summary: DataFrame, source: DataFrame, least: Fraction = LEAST) -> DataFrame:
    """``doc_id, id, source_id, missing, extra``: formulas of a summary whose symbols differ from the source formula they mean.

    Both are ``doc_id, id, latex``. Meant is the most similar one of the document (then the smallest id) if ``least`` of the
    symbols agree; ``missing`` and ``extra`` are the bag differences, sorted. A formula without such a source has a
    null ``source_id`` and all its symbols as ``extra``; one without symbols is no formula.
    """
    a, b = stored(_bags(summary), "summary"), stored(_bags(source), "source")
    a_first, b_first = _firsts(a, least), _firsts(b, least).select("doc_id", F.col("id").alias("source_id"), F.col("size").alias("source_size"), "h")
    near = a_first.join(b_first, ["doc_id", "h"])
    up, down = least.numerator, least.denominator
    near = near.where((F.col("size") * down >= F.col("source_size") * up) & (F.col("source_size") * down >= F.col("size") * up)).select("doc_id", "id", "source_id").distinct()
    pairs = near.join(a, ["doc_id", "id"]).join(b.select("doc_id", F.col("id").alias("source_id"), F.col("size").alias("source_size"), F.col("elements").alias("source_elements")), ["doc_id", "source_id"])
    shared = F.size(F.array_intersect("elements", "source_elements"))
    # Compared once a pair, however often the number is read.
    pairs = pairs.select("*", F.explode(F.array(shared)).alias("shared")).withColumn("all", F.col("size") + F.col("source_size") - F.col("shared")).where(F.col("shared") * down >= F.col("all") * up)
    best = Window.partitionBy("doc_id", "id").orderBy(F.desc(F.col("shared") * F.lit(1.0) / F.col("all")), "source_id")
    meant = pairs.withColumn("nth", F.row_number().over(best)).where("nth = 1").select("doc_id", "id", "source_id", "source_elements")
    rows = a.join(meant, ["doc_id", "id"], "left")
    bag = lambda one, other: F.array_sort(F.transform(F.array_except(one, F.coalesce(other, F.array().cast("array<struct<symbol:string,copy:int>>"))), lambda e: e["symbol"]))
    rows = rows.select("doc_id", "id", "source_id", F.when(F.col("source_id").isNotNull(), bag(F.col("source_elements"), F.col("elements"))).otherwise(F.array().cast("array<string>")).alias("missing"), bag(F.col("elements"), F.col("source_elements")).alias("extra"))
    return rows.where("source_id is null or size(missing) + size(extra) > 0")
