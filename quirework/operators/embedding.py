"""Figures as lines of a summary: put where their item stands, kept in its quote, side by side, and found where they don't belong.

A figure becomes rows of the line table at a computed place: rows of both tables sort by place, side, figure and line,
and are numbered anew. Nothing but the file name tells whether a figure is there already, so a second run adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import caption_reference, short_caption, strip
from ..plans.lines import after, before, forward, latch, line_context, rows_through
from .figures import width_percent
from .rewriters import _replaced, numbered
from .rules import _is

# Fixed values of the document format: synonyms and English names of item kinds, where an item's text stops, and the lines around images.
SYNONYMS = {"例": ("例", "示例"), "评注": ("评注", "注释", "注"), "假设": ("假设", "假定")}
ITEM_STOP = r"^\s*\*\*[定理引命题推论例义公]"
IMAGE_HEAD, IMAGE_END = r"^\s*>\s*\*{0,2}(?:证明|证|例)", r"^(?:---+\s*$|##\s|\*\*[^*]+\*\*)"
FLEX = '<div style="display:flex; gap:6px; flex-wrap:wrap; justify-content:center">'
SHOWN = r'src="_extract/figure/([^"]+)"'


def _english(kind: Column) -> Column:
    names = {cn: en for en, cn in reversed(P.CANONICAL.items()) if en.isascii()}
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), kind), kind)


def candidates(kind: Column, number: Column) -> Column:
    """The beginnings of bold labels that may stand for an item: its kind's synonyms, then its English name."""
    synonyms = F.coalesce(F.element_at(F.create_map(*[x for cn, names in SYNONYMS.items() for x in (F.lit(cn), F.array(*map(F.lit, names)))]), kind), F.array(kind))
    forms = lambda k: F.array(F.concat(F.lit("**"), k, F.lit(" "), number), F.concat(F.lit("**"), k, number), F.concat(F.lit("**"), number, F.lit(" "), k))
    return F.flatten(F.transform(F.concat(synonyms, F.array(_english(kind))), forms))


def shown(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no, line, file`` of every figure that a line shows."""
    return lines.where(F.contains("line", F.lit("_extract/figure/"))).select("doc_id", "line_no", "line", F.explode(F.regexp_extract_all("line", F.lit(SHOWN), F.lit(1))).alias("file"))


def places(lines: DataFrame, figures: DataFrame) -> DataFrame:
    """``doc_id, fig, line_no, of_proof``: the line that heads the item which a figure's caption names.

    Candidates of the caption come before ``anchors`` given by hand, a line that begins with one before a line that
    holds one, an earlier candidate before an earlier line.
    """
    reference = caption_reference(F.col("caption"))
    rows = figures.withColumn("_r", reference)
    none = F.array().cast("array<string>")
    own = F.when(F.col("_r").isNotNull(), candidates(F.col("_r.kind"), F.col("_r.number"))).otherwise(none)
    tagged = lambda xs, by_hand, proof: F.transform(xs, lambda x, i: F.struct(F.lit(by_hand).alias("by_hand"), i.alias("nth"), x.alias("text"), proof.alias("of_proof")))
    every = F.concat(tagged(own, 0, F.coalesce(F.col("_r.of_proof"), F.lit(False))), tagged(F.coalesce("anchors", none), 1, F.coalesce("anchors_proof", F.lit(False))))
    wanted = rows.select("doc_id", "fig", F.explode(F.filter(every, lambda c: c["text"] != "")).alias("c"))
    met = lines.select("doc_id", "line_no", "line").join(wanted, "doc_id").where(F.contains("line", F.col("c.text")))
    begins = F.startswith(strip(F.regexp_replace("line", r"^\s*[> ]*", "")), F.col("c.text"))
    rank = F.struct("c.by_hand", F.when(begins, 0).otherwise(1).alias("holds"), "c.nth", "line_no", "c.of_proof")
    return met.groupBy("doc_id", "fig").agg(F.min(rank).alias("r")).select("doc_id", "fig", "r.line_no", "r.of_proof")


def embedded(lines: DataFrame, figures: DataFrame) -> DataFrame:
    """``lines`` with the figures that none of them shows yet: below their item's text, or inside the quote of its proof.

    ``figures(doc_id, fig, page, file, caption, x0, x1, anchors, anchors_proof)``; a figure without a place stays out.
    Of several figures at one place the later one comes first.
    """
    new = figures.join(shown(lines).select("doc_id", "file").distinct(), ["doc_id", "file"], "left_anti")
    stop = F.startswith("line", F.lit(">")) | F.startswith(strip(F.col("line")), F.lit("---")) | F.startswith("line", F.lit("##")) | F.startswith("line", F.lit("# ")) | _is("line", ITEM_STOP)
    where_ = after(F.when(stop, F.struct("line_no", F.startswith("line", F.lit(">")).alias("quoted"))))
    ends = F.max("line_no").over(Window.partitionBy("doc_id"))
    stops = lines.select("doc_id", "line_no", where_.alias("stop"), ends.alias("last"))
    at = places(lines, new).join(stops, ["doc_id", "line_no"]).join(new, ["doc_id", "fig"])
    quoted = F.col("of_proof") & F.coalesce(F.col("stop.quoted"), F.lit(False))
    tag = F.coalesce(F.nullif(F.regexp_extract(F.coalesce("caption", F.lit("")), r"(图\s*\d+)", 1), F.lit("")), F.lit("图"))
    alt = F.replace(F.concat(tag, F.lit(" "), short_caption(F.col("caption"))), F.lit('"'), F.lit("'"))
    image = F.concat(F.lit('<img src="_extract/figure/'), "file", F.lit('" alt="'), alt, F.lit('" width="'), width_percent("x0", "x1").cast("string"), F.lit('%" height="auto">'))
    said = F.when(quoted, F.array(F.lit(">"), F.concat(F.lit("> "), image))).when(F.col("of_proof"), F.array(F.lit(""), image, F.lit(""))).otherwise(F.array(F.lit(""), image))
    place = F.when(quoted, F.col("stop.line_no") + 1).otherwise(F.coalesce(F.col("stop.line_no"), F.col("last") + 1))
    order = F.struct(-F.col("page").cast("long"), -F.col("fig").cast("long")).alias("later")
    added = at.select("doc_id", place.cast("int").alias("place"), F.lit(0).alias("side"), order, F.posexplode(said).alias("pos", "line"))
    own = lines.select("doc_id", F.col("line_no").alias("place"), F.lit(1).alias("side"), F.lit(None).cast(added.schema["later"].dataType).alias("later"), F.lit(0).alias("pos"), "line")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("place", "side", "later", "pos"))
    return own.unionByName(added).select("doc_id", nth.alias("line_no"), "line")


def images_continued(lines: DataFrame) -> DataFrame:
    """Blank lines inside a proof's or example's quote become quoted ones, so that its images stay in it."""
    ctx = line_context(lines)
    ends = lambda c: _is(c, IMAGE_END) & ~F.coalesce(F.startswith(F.ltrim(F.col(c)), F.lit(">")), F.lit(False))
    inside = latch(_is("line", IMAGE_HEAD), ends("line"))
    goes_on = F.col("nnb").isNotNull() & ~_is("nnb", IMAGE_HEAD) & ~ends("nnb")
    return _replaced(ctx, F.when(F.col("blank") & inside & goes_on, "> ").otherwise(F.col("line")))


def _core(line: Column) -> Column:
    return F.regexp_replace(strip(line), r"^>*\s*", "")


def _prefix(line: Column) -> Column:
    lead = F.ltrim(line)
    return F.when(F.startswith(lead, F.lit("> ")), "> ").when(F.startswith(lead, F.lit(">")), ">").otherwise("")


def images_side_by_side(lines: DataFrame) -> DataFrame:
    """Runs of image lines in one flex block without blank lines, a blank line before and after it; blocks that are there are tidied.

    Blank lines between images and after them go, but for those before display maths.
    """
    ctx = line_context(lines).withColumn("core", _core(F.col("line")))
    opens, closes = F.startswith("core", F.lit(FLEX)), F.col("core") == "</div>"
    image = F.startswith("core", F.lit("<img")) & F.endswith("core", F.lit(">"))
    ctx = ctx.withColumns({"held": latch(opens, closes), "opens": opens, "closes": closes, "image": image, "void": F.col("t").isin("", ">")})
    ctx = ctx.withColumns({"opens": F.col("opens") & ~F.col("held"), "closes": F.col("closes") & F.col("held")})
    # Blocks that are there: from the opening line to the closing one, or to the end.
    ctx = ctx.withColumn("block", F.when(F.col("held") | F.col("opens"), F.sum(F.col("opens").cast("int")).over(rows_through())))
    solid = F.when(~F.col("void"), F.struct((F.col("image") & ~F.col("held")).alias("image"), F.col("t").isin("$$", "> $$").alias("fence")))
    ctx = ctx.withColumns({"was": before(solid), "next": after(solid)})
    follows = F.coalesce(F.col("was.image"), F.lit(False))
    ctx = ctx.withColumn("fresh", F.col("image") & ~F.col("held"))
    ctx = ctx.withColumn("run", F.sum((F.col("fresh") & ~follows).cast("int")).over(rows_through()))
    swallowed = F.col("void") & ~F.col("held") & follows & ~F.coalesce(F.col("next.fence"), F.lit(False))
    key = Window.partitionBy("doc_id", F.coalesce("block", -F.col("run")))
    first = F.min(F.when(F.col("opens") | F.col("fresh"), F.struct("line_no", _prefix(F.col("line")).alias("prefix")))).over(key)["prefix"]
    last_held = F.col("held") & F.col("n1").isNull() & ~F.col("closes")
    ctx = ctx.withColumns({"prefix": first, "swallowed": swallowed, "last_held": last_held})
    begin, shown_, end = F.concat("prefix", F.lit(FLEX)), F.concat("prefix", F.lit("  "), "core"), F.concat("prefix", F.lit("</div>"))
    none = F.array().cast("array<string>")
    one = lambda when, line: F.when(when, F.array(line)).otherwise(none)
    in_block = F.concat(one(F.col("image"), shown_), one(F.col("closes") | F.col("last_held"), end))
    in_run = F.concat(one(~follows, begin), F.array(shown_), one(~F.coalesce(F.col("next.image"), F.lit(False)), end))
    alone = F.col("opens") & F.col("n1").isNull()
    new = F.when(F.col("opens"), F.concat(F.array(begin), one(alone, end))).when(F.col("held"), in_block).when(F.col("fresh"), in_run).when(F.col("swallowed"), none).otherwise(F.array("line"))
    rows = numbered(ctx, new).withColumns({"p1": F.lag("line").over(forward()), "n1": F.lead("line").over(forward()), "core": _core(F.col("line"))})
    tight = lambda c: ~F.coalesce(strip(F.col(c)).isin("", ">"), F.lit(True))
    blank = F.when(_prefix(F.col("line")) == "", "").otherwise(">")
    above = one(F.startswith("core", F.lit(FLEX)) & tight("p1") & (_core(F.col("p1")) != "</div>"), blank)
    below = one((F.col("core") == "</div>") & tight("n1"), blank)
    return numbered(rows, F.concat(above, F.array("line"), below))


def out_of_block(lines: DataFrame, figures: DataFrame) -> DataFrame:
    """``doc_id, line_no, file, fault`` of shown figures that don't stand where their caption says.

    ``figures(doc_id, file, caption)``. Items are intervals of lines from their label to the next one; one sweep over the
    lines tells each image its interval and whether a proof's or example's quote is open. ``outside``: the caption names
    a proof or an example, and the image is not in such a quote. ``other_item``: it stands in another item than named.
    """
    number = F.nullif(F.regexp_replace(F.regexp_extract("line", rf"^\s*(?:>\s*)?\*\*(?:{P.CAPTION_KINDS}|{'|'.join(P.CAPTION_KINDS_EN)})\s*{P.CAPTION_NUMBER}", 1), r"\s+", ""), F.lit(""))
    heads = _is("line", IMAGE_HEAD)
    quote = latch(heads, _is("line", IMAGE_END) & ~F.startswith(F.ltrim(F.col("line")), F.lit(">")))
    swept = lines.withColumns({"item": before(number), "open": quote & F.startswith(F.ltrim(F.col("line")), F.lit(">"))})
    images = swept.where(F.contains("line", F.lit("_extract/figure/"))).select("doc_id", "line_no", "item", "open", F.explode(F.regexp_extract_all("line", F.lit(SHOWN), F.lit(1))).alias("file"))
    rows = images.join(figures.select("doc_id", "file", caption_reference(F.col("caption")).alias("r")).where("r is not null"), ["doc_id", "file"])
    fault = F.when((F.col("r.of_proof") | F.col("r.kind").isin("例", "示例")) & ~F.col("open"), "outside").when(F.coalesce(F.col("item"), F.lit("")) != F.col("r.number"), "other_item")
    return rows.select("doc_id", "line_no", "file", fault.alias("fault")).where("fault is not null")
