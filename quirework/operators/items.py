"""Numbered items in scanned text blocks, and the recovery of gaps in their numbering.

Blocks are rows ``book, page, block, text`` in reading order (``page, block``); ``chapters`` give each book one
chapter number and page range: ``book, ch, start, end``. A chapter is the unit of every window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_label
from ..plans.stored import stored

# Fixed values of the document format.
NUMBER = r"(\d+)\s*[.\-·，\s]\s*(\d+)\s*[\-.·，\s]\s*(\d+)"
GARBLED = r"(\d)(\d)[\s_\-·]\s*(\d+)"
LABEL = r"(?:定义|定理|引理|推论|命题)\s*（|例(?:子)?|Example|Definition|Theorem|Lemma|Corollary|Proposition"
CITES = r"见|由|根据|参考|参见|据|Cf\."
FULL_LABEL = "定理|定义|引理|推论|命题|例"
SECTION_HEAD = r"^(?:§\s*)?(\d+)\.(\d+)(?:\s{2,}|\s+[^\d\-])"
SECTION_LABEL = r"^(?:例子?|Examples?)$"
TWO_LEVEL = r"(定义|定理|引理|推论|命题)\s*(\d+)\.(\d+)"
ENGLISH = r"(Definition|Theorem|Lemma|Proposition|Corollary|Example|Assertion|Conjecture|Remark)\s*(?:\([^)]*\))?\s*(\d+)\s*\.\s*(\d+)"
SECTION_ONLY = r"(定义|定理|引理|推论|命题|Definition|Theorem|Lemma|Corollary|Proposition)\s*[（(]?\s*(\d{1,2})\.(\d{1,3})[）)]?"
TRAILING_CITE = r"(?i)(?:见|由|根据|参考|参见|据|cf\.|see|by|from|in)\s*$"
MOST_SECTION, MOST_NUMBER = 15, 50
BARE = "裸"
#: Pages without a recovered item after which a section's end is suspicious.
TAIL = 5


#: Stands around a match while a text is cut; in texts it counts as another control character.
_MARK = "\x01"
#: Pieces of a text whose lengths are summed as one step.
_STEP = 512


def _groups(pattern: str) -> int:
    return min(3, pattern.replace("(?:", "").replace("\\(", "").replace("(?i)", "").replace("[（(]", "").replace("[（(", "").count("("))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row, however many elements of another one's lambda read it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def _steps(lengths: str) -> Column:
    """The sum of all lengths before each step."""
    return F.transform(F.sequence(F.lit(0), F.expr(f"(size({lengths}) - 1) div {_STEP}")), lambda c: _sum(F.slice(lengths, F.lit(1), c * _STEP)))


def _placed(k: int) -> Column:
    """The matches among the pieces ``_p`` of pattern ``k``: every second piece, with its offset."""
    at = lambda i: F.get(f"_s{k}", F.floor(i / _STEP).cast("int")) + _sum(F.slice(f"_n{k}", i - i % _STEP + 1, i % _STEP))
    odd = F.when(F.size(f"_p{k}") > 1, F.sequence(F.lit(1), F.size(f"_p{k}") - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(odd, lambda i, j: F.struct(F.lit(k).alias("kind"), j.alias("nth"), F.get(f"_p{k}", i).alias("said"), at(i).alias("at")))


def matches(rows: DataFrame, *patterns: str, text: str = "text") -> DataFrame:
    """One row a match: ``kind`` (which pattern), ``nth`` (from 0), ``said``, ``at`` (offset from 0), ``upto`` (its end), groups ``g1`` to ``g3``.

    A pattern marks its matches in one pass, the marked text is cut at the marks, and offsets are sums of the
    pieces' lengths: whole steps of ``_STEP`` pieces first, then single ones, so that n matches take n * _STEP additions.
    """
    rows = rows.where(reduce(Column.__or__, [F.col(text).rlike(p) for p in patterns]))
    found = []
    for k, pattern in enumerate(patterns):
        rows = _once(rows, f"_p{k}", F.split(F.regexp_replace(F.translate(text, _MARK, "\x02"), pattern, f"{_MARK}$0{_MARK}"), _MARK, -1))
        rows = _once(rows, f"_n{k}", F.transform(f"_p{k}", F.length))
        rows = _once(rows, f"_s{k}", _steps(f"_n{k}"))
        found.append(_placed(k))
    rows = rows.withColumn("_f", F.explode(F.concat(*found)))
    rows = rows.select("*", "_f.*").drop("_f", *[f"_{c}{k}" for c in "pns" for k in range(len(patterns))]).withColumn("upto", F.col("at") + F.length("said"))
    group = lambda i: F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract("said", p, i)) for k, p in enumerate(patterns) if i <= _groups(p)])
    return rows.withColumns({f"g{i}": group(i) for i in range(1, max(map(_groups, patterns)) + 1)})


def part(text: str, start: Column, end: Column) -> Column:
    """``text[start:end]`` with offsets from 0; a negative start is 0."""
    start = F.greatest(start, F.lit(0))
    return F.substring(F.col(text), start + 1, F.greatest(end - start, F.lit(0)))


def reading_order(blocks: DataFrame) -> DataFrame:
    """Adds the neighbouring blocks and the section label that is in force."""
    order = Window.partitionBy("book").orderBy("page", "block")
    tidy = F.regexp_replace(F.btrim("text"), "[：:．.，, ]+$", "")
    blocks = blocks.where("btrim(text) <> ''").withColumn("tidy", tidy)
    event = F.when(F.col("tidy").rlike(SECTION_LABEL), "例").when(F.col("tidy").rlike(SECTION_HEAD), "")
    blocks = blocks.withColumns({"seq": F.row_number().over(order), "prev": F.lag("text").over(order), "following": F.lead("text").over(order), "event": event})
    force = F.last("event", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return blocks.withColumn("force", F.nullif(force, F.lit(""))).withColumn("heads", F.col("tidy").rlike(SECTION_LABEL))


def _label(text: Column) -> Column:
    said = F.regexp_extract(text, f"({LABEL})", 1)
    case = F.when(said.rlike("例|Example"), "例")
    for cn, en in (("定义", "Definition"), ("定理", "Theorem"), ("引理", "Lemma"), ("推论", "Corollary"), ("命题", "Proposition")):
        case = case.when(said.rlike(f"{cn}|{en}"), cn)
    return case


def _candidates(blocks: DataFrame) -> DataFrame:
    """Matches of both patterns with the texts around them, references already left out."""
    rest = F.btrim(F.expr("substring(text, upto + 1)"))
    rows = matches(blocks, NUMBER, GARBLED)
    rows = rows.where((F.col("kind") == 0) | ((F.col("nth") == 0) & (F.length(rest) >= 8) & F.substring(rest, 1, 12).rlike(r"\p{L}")))
    rows = rows.withColumns({g: F.col(g).try_cast("int") for g in ("g1", "g2", "g3")})
    rows = rows.where(F.col("g1") == F.col("ch")).where((F.col("g2") <= MOST_SECTION) & (F.col("g3") <= MOST_NUMBER))
    at, upto = F.col("at"), F.col("upto")
    rows = rows.withColumns({"before": part("text", at - 25, at), "after": part("text", upto, upto + 50), "lead": part("text", F.lit(0), at)})
    cited = F.col("before").rlike(CITES) | F.coalesce(F.btrim(F.expr("right(prev, 15)")).rlike(CITES), F.lit(False))
    labelled = F.expr("right(lead, 8)").rlike(rf"(?:{FULL_LABEL})[\s（）()]*$") & ~F.btrim("lead").rlike(f"^(?:{FULL_LABEL})$")
    tail = F.expr("substring(text, upto + 1)")
    opened = F.when(F.contains("lead", F.lit("（")), F.element_at(F.split("lead", "（", -1), -1)).when(F.contains("lead", F.lit("(")), F.element_at(F.split("lead", r"\(", -1), -1))
    closed = F.when(F.contains(tail, F.lit("）")), F.get(F.split(tail, "）", 2), F.lit(0))).when(F.contains(tail, F.lit(")")), F.get(F.split(tail, r"\)", 2), F.lit(0)))
    listed = F.coalesce(F.regexp_count(F.concat(opened, F.col("said"), closed), F.lit(NUMBER)) >= 2, F.lit(False))
    near = F.col("before").rlike(NUMBER) | F.substring("after", 1, 40).rlike(NUMBER) | F.concat("before", F.substring("after", 1, 40)).rlike("[到至～]")
    ranged = F.col("before").rlike("[例定引推]") & near
    return rows.where(~cited & ~labelled & ~listed & ~ranged)


def three_level(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    """Items ``N.S-N``: ``book, key, section, number, page, label, text``; of equal keys the first with a label stays."""
    within = blocks.join(chapters, "book").where("page between start and end")
    rows = _candidates(reading_order(within).where("not heads"))
    rows = rows.withColumn("key", F.format_string("%d.%d-%d", "g1", "g2", "g3"))
    order = Window.partitionBy("book", "key").orderBy("seq", "kind", "at")
    rows = rows.withColumn("nth_key", F.row_number().over(order)).where("kind = 0 or nth_key = 1")
    own = _label(F.concat("before", F.substring("after", 1, 40)))
    prev, following = _label(F.expr("right(prev, 40)")), _label(F.substring("following", 1, 40))
    label = F.coalesce(own, "force", F.when(prev.isin("例", "定义"), prev), F.when(following.isin("例", "定义", "定理"), following), F.lit(BARE))
    rows = rows.withColumns({"label": label, "snippet": part("text", F.col("at") - 5, F.col("upto") + 80)})
    best = F.row_number().over(Window.partitionBy("book", "key").orderBy(F.col("label") == BARE, "seq", "kind", "at"))
    rows = rows.withColumn("best", best).where("best = 1")
    return rows.select("book", "key", F.col("g2").alias("section"), F.col("g3").alias("number"), "page", "label", F.col("snippet").alias("text"))


def _first(rows: DataFrame) -> DataFrame:
    """Of equal keys of a book the first in reading order."""
    order = Window.partitionBy("book", "key").orderBy("page", "block", "at")
    return rows.withColumn("nth_key", F.row_number().over(order)).where("nth_key = 1").select("book", "key", "label", "page")


def two_level(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    rows = matches(blocks.join(chapters, "book").where("page between start and end"), TWO_LEVEL).where(F.col("g2").try_cast("int") == F.col("ch"))
    return _first(rows.withColumns({"label": F.col("g1"), "key": F.concat("g1", F.col("g2").cast("int").cast("string"), F.lit("."), F.col("g3").cast("int").cast("string"))}))


def english(blocks: DataFrame, chapters: DataFrame) -> DataFrame:
    rows = matches(blocks.join(chapters, "book").where("page between start and end"), ENGLISH).where(F.col("g2").try_cast("int") == F.col("ch"))
    return _first(rows.withColumns({"label": canonical_label(F.col("g1")), "key": F.concat(canonical_label(F.col("g1")), F.lit(" "), "g2", F.lit("."), "g3")}))


def section_only(blocks: DataFrame) -> DataFrame:
    """Items ``S.N`` of books whose chapter numbers are not part of the key; references that end in a cite word go."""
    rows = matches(blocks, SECTION_ONLY).withColumns({"lead": part("text", F.col("at") - 12, F.col("at")), "s": F.col("g2").cast("int"), "n": F.col("g3").cast("int")})
    rows = rows.where((F.col("s") <= 20) & (F.col("n") <= 80) & ~F.col("lead").rlike(TRAILING_CITE))
    return _first(rows.withColumns({"label": canonical_label(F.col("g1")), "key": F.concat(canonical_label(F.col("g1")), F.format_string("%d.%d", "s", "n"))}))


def section_gaps(items: DataFrame, chapters: DataFrame) -> DataFrame:
    """Where numbers are missing: ``book, section, gap, low, high`` (numbers) and ``first_page, last_page`` to look at.

    Head, internal and tail gaps follow from the section's first and last item; a tail ends where the next section
    begins or the chapter ends.
    """
    s = items.groupBy("book", "section").agg(
        F.min_by("number", "number").alias("low"), F.max("number").alias("high"), F.min_by("page", F.struct("number", "page")).alias("from_page"), F.max_by("page", F.struct("number", "page")).alias("to_page"),
        F.min("page").alias("min_page"), F.countDistinct("number").alias("held"), F.min_by("label", F.when(F.col("label") != BARE, F.col("number"))).alias("section_label"),
    )
    following = F.lead("min_page").over(Window.partitionBy("book").orderBy("section"))
    s = s.withColumn("next_page", following).join(chapters, "book")
    gap = lambda kind, low, high, a, b, when: F.when(when, F.struct(F.lit(kind).alias("gap"), low.alias("gap_low"), high.alias("gap_high"), a.cast("int").alias("first_page"), b.cast("int").alias("last_page")))
    end = F.coalesce(F.col("next_page") - 1, F.col("end"))
    gaps = F.array(
        gap("head", F.lit(1), F.col("low") - 1, F.greatest(F.lit(1), F.col("start")), F.col("from_page") - 1, F.col("low") > 1),
        gap("internal", F.col("low"), F.col("high"), F.col("from_page"), F.col("to_page"), F.col("held") < F.col("high") - F.col("low") + 1),
        gap("tail", F.col("high") + 1, F.lit(None).cast("int"), F.col("to_page") + 1, end, end - F.col("to_page") >= 1),
    )
    return s.select("book", "ch", "section", "section_label", F.explode(F.filter(gaps, lambda g: g.isNotNull())).alias("g")).select("book", "ch", "section", "section_label", "g.*")


def recover_gaps(blocks: DataFrame, items: DataFrame, chapters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """-> (recovered items, verdict of each gap).

    Gap pages are searched again without the reference filter; an unseen key of the section is taken if it has a
    label or letters around it. A head or internal gap of which some but not all came back blocks; a tail gap of more
    than ``TAIL`` pages without a find is suspicious; everything else is resolved.
    """
    items = stored(items, "items")
    stage = F.when(F.col("gap") == "head", 0).when(F.col("gap") == "internal", 1).otherwise(2)
    gaps = stored(section_gaps(items, chapters).withColumn("stage", stage), "gaps")
    # A range join within a book: no range is written out page by page, however far it reaches.
    again = blocks.where("btrim(text) <> ''").withColumn("text", F.btrim("text"))
    again = again.join(gaps.where("last_page >= first_page"), "book").where("page between first_page and last_page")
    found = matches(again, NUMBER, GARBLED).where("kind = 0 or nth = 0")
    found = found.where((F.col("g1").try_cast("int") == F.col("ch")) & (F.col("g2").try_cast("int") == F.col("section"))).withColumn("number", F.col("g3").try_cast("int"))
    found = found.withColumns({"snippet": part("text", F.col("at") - 5, F.col("upto") + 30), "key": F.format_string("%d.%d-%d", F.col("ch").cast("int"), F.col("section").cast("int"), "number")})
    found = found.withColumn("label", F.coalesce(_label(F.col("snippet")), "section_label", F.lit(BARE)))
    found = found.where((F.col("label") != BARE) | (F.regexp_count("snippet", F.lit(r"\p{L}")) >= 2) | F.contains("snippet", F.lit("\\")))
    found = found.join(items.select("book", "key"), ["book", "key"], "left_anti")
    order = Window.partitionBy("book", "key").orderBy("stage", "page", "block", "kind", "at")
    found = found.withColumn("nth_key", F.row_number().over(order)).where("nth_key = 1")
    recovered = stored(found.select("book", "key", "section", "number", "page", "label", F.substring("snippet", 1, 120).alias("text"), "stage"), "recovered")

    held = items.select("book", "section", "number").withColumn("stage", F.lit(-1)).unionByName(recovered.select("book", "section", "number", "stage"))
    now = gaps.join(held.withColumnRenamed("stage", "since"), ["book", "section"])
    inside = (F.col("number") >= F.col("gap_low")) & (F.col("number") <= F.col("gap_high")) & (F.col("since") <= F.col("stage"))
    counts = now.groupBy("book", "section", "gap", "gap_low", "gap_high", "first_page", "last_page").agg(
        F.countDistinct(F.when(inside, F.col("number"))).alias("filled"), F.count_if(F.col("since") == F.col("stage")).alias("recovered")
    )
    missing = F.col("gap_high") - F.col("gap_low") + 1 - F.col("filled")
    verdict = (
        F.when(F.col("gap") == "tail", F.when((F.col("recovered") == 0) & (F.col("last_page") - F.col("first_page") + 1 > TAIL), "suspicious").otherwise("resolved"))
        .when((F.col("recovered") > 0) & (missing > 0), "blocking")
        .otherwise("resolved")
    )
    return recovered.drop("stage"), counts.select("book", "section", "gap", "recovered", F.coalesce(missing, F.lit(0)).cast("int").alias("missing"), verdict.alias("verdict"))


def continuity(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``keys, low, high, n, missing`` for each sequence with holes; ``missing`` is their count."""
    out = rows.groupBy(*keys).agg(F.min(number).alias("low"), F.max(number).alias("high"), F.countDistinct(number).alias("n"))
    return out.withColumn("missing", F.col("high") - F.col("low") + 1 - F.col("n")).where("missing > 0")
