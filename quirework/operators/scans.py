"""Looking things up in scanned blocks: scanners, references, contexts, tails, and the order that lists come in.

Blocks are rows ``book, page, block, text`` as in ``items``; ``chapters`` are ``book, ch, start, end``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import natural_key, strip
from .items import CITES, NUMBER, matches, part

#: Pages of a chapter that are searched for the tail of a list, how far beyond its end, and characters around a number.
TAIL_PAGES, TAIL_REACH, AROUND = 20, 10, 200
FOUND_LABEL = "(定义|定理|引理|命题|推论|例|Example|Definition|Theorem|Lemma|Proposition|Corollary)"


def _within(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    return blocks.join(chapters, "book").where("page between start and end").withColumn("text", strip(F.col("text"))).where("text <> ''")


def two_level_scan(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    """``book, kind, key, number, label, page, text``: sections, definitions, theorems (all other labels share one count) and examples.

    Of equal keys the first in reading order stays; examples are kept one by one with the section in force as their key.
    """
    rows = _within(blocks, chapters)
    order = Window.partitionBy("book").orderBy("page", "block")
    head = lambda i: F.regexp_extract("text", P.SCAN_SECTION, i)
    chapter = F.col("ch").cast("string")
    heads = F.col("text").rlike(P.SCAN_SECTION) & ((head(2) == chapter) | ((head(1) == "8") & (F.concat(F.lit("8"), head(2)) == chapter)))
    rows = rows.withColumn("heads", F.when(heads, F.concat(chapter, F.lit("."), head(3))))
    rows = rows.withColumn("section", F.last("heads", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = ["book", "page", "block"]
    sections = rows.where("heads is not null").select(*place, F.lit(0).alias("at"), F.lit("section").alias("kind"), F.col("heads").alias("key"), head(3).alias("number"), F.lit(None).cast("string").alias("label"), strip(head(4)).alias("text"))
    found = matches(rows, P.SCAN_ITEM).where(F.col("g2") == chapter)
    labelled = found.select(*place, "at", F.when(F.col("g1") == "定义", "definition").otherwise("theorem").alias("kind"), F.concat("g2", F.lit("."), "g3").alias("key"), F.col("g3").alias("number"), F.col("g1").alias("label"), part("text", F.col("at") - 2, F.col("at") + 55).alias("text"))
    first = F.row_number().over(Window.partitionBy("book", "kind", "key").orderBy("page", "block", "at"))
    firsts = sections.unionByName(labelled).withColumn("nth", first).where("nth = 1").drop("nth")
    examples = rows.where(F.col("text").rlike(P.SCAN_EXAMPLE) & ~F.col("text").rlike(P.SCAN_EXAMPLE + r"[.·]\d"))
    examples = examples.select(*place, F.lit(0).alias("at"), F.lit("example").alias("kind"), F.col("section").alias("key"), F.regexp_extract("text", P.SCAN_EXAMPLE, 1).alias("number"), F.lit("例").alias("label"), F.substring("text", 1, 55).alias("text"))
    return firsts.unionByName(examples).select("book", "kind", "key", F.col("number").try_cast("long").alias("number"), "label", "page", "text")


def holes(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``keys, low, high, n, holes``: the numbers that a sequence leaves out, as ranges ``first, last``."""
    each = rows.where(F.col(number).isNotNull()).select(*keys, F.col(number).alias("_n")).distinct()
    prev = F.lag("_n").over(Window.partitionBy(*keys).orderBy("_n"))
    each = each.withColumn("_gap", F.when(F.col("_n") - prev > 1, F.struct((prev + 1).alias("first"), (F.col("_n") - 1).alias("last"))))
    return each.groupBy(*keys).agg(F.min("_n").alias("low"), F.max("_n").alias("high"), F.count("*").alias("n"), F.array_sort(F.collect_list("_gap")).alias("holes"))


def found_items(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    """``book, key, page, tag, said, snippet`` of every three-level number, first of each key; the tag tells a citation, a label or neither."""
    order = Window.partitionBy("book").orderBy("page", "block")
    rows = _within(blocks, chapters).withColumns({"prev": F.lag("text").over(order), "following": F.lead("text").over(order)})
    rows = matches(rows, NUMBER).where(F.col("g1").try_cast("int") == F.col("ch"))
    before = part("text", F.col("at") - 15, F.col("at"))
    around = [F.concat(before, part("text", F.col("upto"), F.col("upto") + 20)), F.concat(F.expr("right(prev, 20)"), F.substring("text", 1, 20)), F.concat(F.expr("right(text, 20)"), F.substring("following", 1, 20))]
    label = F.coalesce(*[F.nullif(F.regexp_extract(c, FOUND_LABEL, 1), F.lit("")) for c in around], F.lit("NUM"))
    key = F.concat_ws("-", F.concat_ws(".", "ch", F.col("g2").try_cast("bigint")), F.col("g3").try_cast("bigint"))
    rows = rows.withColumns({"key": key, "tag": F.when(before.rlike(CITES), "REF").otherwise(label), "snippet": part("text", F.col("at") - 5, F.col("upto") + 30)})
    first = F.row_number().over(Window.partitionBy("book", "key").orderBy("page", "block", "at"))
    return rows.withColumn("nth_key", first).where("nth_key = 1").select("book", "key", "page", "tag", "said", "snippet")


def page_texts(blocks: DataFrame) -> DataFrame:
    """``book, page, text, rows``: the blocks of a page joined by line feeds in the order of ``y``, and where each begins and ends."""
    listed = F.array_sort(F.collect_list(F.struct("y", "block", "text")))
    pages = blocks.where("text <> ''").groupBy("book", "page").agg(listed.alias("listed"))
    step = lambda acc, b: F.struct((acc["to"] + F.length(b["text"]) + 1).alias("to"), F.concat(acc["rows"], F.array(F.struct(acc["to"].alias("start"), (acc["to"] + F.length(b["text"])).alias("end"), b["y"].cast("double").alias("y")))).alias("rows"))
    start = F.struct(F.lit(0).alias("to"), F.array().cast("array<struct<start:int,end:int,y:double>>").alias("rows"))
    return pages.select("book", "page", F.array_join(F.col("listed.text"), "\n").alias("text"), F.aggregate("listed", start, step)["rows"].alias("rows"))


def figure_references(blocks: DataFrame) -> DataFrame:
    """``book, page, label, y``: every figure that a page's text names, captions that are split over blocks included.

    A reference stands where its first block stands. ``blocks`` has ``y``.
    """
    found = matches(page_texts(blocks), P.FIGURE_REFERENCE)
    row = F.get(F.filter("rows", lambda r: (r["start"] <= F.col("at")) & (F.col("at") < r["end"])), F.lit(0))
    return found.select("book", "page", F.col("g1").alias("label"), F.coalesce(row["y"], F.lit(0.0)).alias("y"))


def label_conflicts(items: DataFrame) -> DataFrame:
    """Items whose text says another label than they carry: ``items`` and ``said``."""
    start = F.substring("text", 1, 60)
    said = F.coalesce(*[F.when(start.rlike(pattern), label) for label, pattern in P.TEXT_LABELS])
    return items.withColumn("said", said).where("said is not null and said <> coalesce(label, '')")


def details(keys: DataFrame, items: DataFrame, blocks: DataFrame) -> DataFrame:
    """``book, key, label, page, text, context`` for each of ``keys``: the first item of that key, and its block on its page.

    The text is cut at 150 characters, the context (the first block that holds the text's first 30) at 200. A key without
    an item has nulls.
    """
    first = items.groupBy("book", "key").agg(F.min_by(F.struct("label", "page", F.substring(strip(F.col("text")), 1, 150).alias("text")), "seq").alias("item")).select("book", "key", "item.*")
    rows = keys.join(first, ["book", "key"], "left")
    on = blocks.select("book", "page", F.col("block"), F.col("text").alias("whole"))
    met = rows.join(on, ["book", "page"]).where(F.contains("whole", F.substring("text", 1, 30)))
    context = met.groupBy("book", "key").agg(F.min_by("whole", "block").alias("whole")).select("book", "key", F.substring(strip(F.col("whole")), 1, 200).alias("context"))
    return rows.join(context, ["book", "key"], "left").select("book", "key", "label", "page", "text", "context")


def context_labels(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no, context`` of each line: the topmost of five lines above that introduces notes, else the nearest of four that says something."""
    order = Window.partitionBy("doc_id").orderBy("line_no")
    above = [F.lag("line", k).over(order) for k in range(1, 6)]
    notes = [F.nullif(strip(F.regexp_extract(F.coalesce(x, F.lit("")), P.NOTES, 1)), F.lit("")) for x in reversed(above)]
    said = [F.when((strip(x) != "") & ~F.startswith(strip(x), F.lit("-")), F.substring(strip(x), 1, 30)) for x in above[:4]]
    return lines.select("doc_id", "line_no", F.coalesce(*notes, *said, F.lit("")).alias("context"))


def list_tails(lists: DataFrame, pages: DataFrame) -> DataFrame:
    """``book, list_id, missing``: numbers beyond the end of a list that its scanned pages hold next to numbers of it.

    ``lists(book, list_id, start, context, numbers)`` are lists of a summary; ``pages(book, page, text)`` the scans. Only the
    chapter's first pages count, and of these the ones that hold the context.
    """
    met = lists.join(pages.select("book", "page", "text"), "book").where((F.col("page") >= F.col("start")) & (F.col("page") < F.col("start") + TAIL_PAGES))
    word = strip(F.regexp_replace("context", "[：:]+$", ""))
    met = matches(met.where((word == "") | F.contains("text", word)), P.PAREN_NUMBER).withColumn("n", F.col("g1").cast("int"))
    top = F.array_max("numbers")
    met = met.where((F.col("n") > top) & (F.col("n") <= top + TAIL_REACH))
    near = F.transform(F.regexp_extract_all(part("text", F.col("at") - AROUND, F.col("upto") + AROUND), F.lit(P.PAREN_NUMBER), F.lit(1)), lambda x: x.cast("int"))
    return met.where(F.arrays_overlap(near, F.col("numbers"))).groupBy("book", "list_id").agg(F.array_sort(F.collect_set("n")).alias("missing"))


def source_sections(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    """``book, section, headed, high``: sections of a chapter that a scan heads, and their highest number next to a label."""
    rows = _within(blocks, chapters)
    heads = []
    for pattern, short in ((P.SOURCE_HEAD_GLUED, False), (P.SOURCE_HEAD_PLAIN, False), (P.SOURCE_HEAD_SHORT, True)):
        is_head = F.col("text").rlike(pattern) & (F.regexp_extract("text", pattern, 1).try_cast("int") == F.col("ch")) & (F.lit(not short) | (F.length("text") < 60))
        heads.append(F.when(is_head, F.regexp_extract("text", pattern, 2).try_cast("int")))
    headed = rows.select("book", F.explode(F.array_compact(F.array(*heads))).alias("section")).distinct().withColumn("headed", F.lit(True))
    found = matches(rows, P.SOURCE_NUMBER).where((F.col("g1").cast("int") == F.col("ch")) & (F.col("g3").cast("int") > 0))
    found = found.where(part("text", F.col("at") - 10, F.col("upto") + 10).rlike(P.SOURCE_LABEL))
    high = found.groupBy("book", F.col("g2").cast("int").alias("section")).agg(F.max(F.col("g3").cast("int")).alias("high"))
    return high.join(headed, ["book", "section"], "full").select("book", "section", F.coalesce("headed", F.lit(False)).alias("headed"), "high")


def summary_headings(lines: DataFrame, chapters: DataFrame) -> DataFrame:
    """``doc_id, section`` of the section headings of a summary; ``chapters(doc_id, ch)``."""
    said = strip(F.col("line"))
    rows = lines.where(said.rlike(P.SUMMARY_HEAD)).join(chapters.select("doc_id", "ch"), "doc_id").where(F.regexp_extract(said, P.SUMMARY_HEAD, 1).try_cast("int") == F.col("ch"))
    return rows.select("doc_id", F.regexp_extract(said, P.SUMMARY_HEAD, 2).try_cast("int").alias("section")).distinct()


def raw_dump(blocks: DataFrame) -> DataFrame:
    """``book, page, text``: each page under a banner, blocks in the order of ``y``; pages sort by number."""
    pages = page_texts(blocks)
    return pages.select("book", "page", F.concat(F.lit("\n===== PAGE "), F.col("page").cast("string"), F.lit(" =====\n\n"), "text", F.lit("\n")).alias("text"))


def page_view(scans: DataFrame) -> DataFrame:
    """``book, page, n_formulas, n_blocks, text, formulas`` of page scans as ``stores.pages`` reads them."""
    texts = F.filter(F.transform(F.coalesce("text", F.array().cast(scans.schema["text"].dataType)), lambda b: F.btrim(b["text"])), lambda t: t != "")
    return scans.select("book", "page", F.coalesce(F.size("formulas"), F.lit(0)).alias("n_formulas"), F.coalesce(F.size("text"), F.lit(0)).alias("n_blocks"), F.array_join(texts, "\n").alias("text"), F.col("formulas.latex").alias("formulas"))


def by_page_and_key(items: DataFrame) -> DataFrame:
    """Adds ``nth``: items of a book by page, then by key as text (``1.10-1`` before ``1.2-1``)."""
    return items.withColumn("nth", F.row_number().over(Window.partitionBy("book").orderBy("page", "key")))


def natural(rows: DataFrame, within: list[str], key: str = "key") -> DataFrame:
    """Adds ``nth``: rows by the numbers in their key, then by the key as text."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*within).orderBy(natural_key(F.col(key)), F.col(key))))


def status_order(compared: DataFrame) -> DataFrame:
    """Adds ``nth`` to ``keys.compare``: missing keys in the order of text, all others by their numbers."""
    text: Column = F.when(F.col("status") == "missing", F.col("key"))
    numbers = F.when(F.col("status") != "missing", natural_key(F.col("key")))
    return compared.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "status").orderBy(text, numbers, "key")))

