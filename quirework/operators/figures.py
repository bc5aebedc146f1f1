"""Figures: page ranges, nearest captions, points in boxes, one-to-one assignment, names and merges."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stored import stored

# Fixed values of the document format: figure labels, Chinese before English.
FIGURE_CN = r"图\s*(\d+)[.\-](\d+)(?:[.\-](\d+))?"
FIGURE_EN = r"(?i)(?:fig(?:ure)?\.?)\s*(\d+)[.\-](\d+)(?:[.\-](\d+))?"
#: Vertical distance up to which a reference may name a figure; page width and padding of a crop in pixels.
REACH, PAGE_WIDTH, PADDING, DEFAULT_WIDTH = 500, 1653, 16, 45.0


#: Bits of the numbers that ranges are over.
_LEVELS = 33


def _dyadic(low: Column, high: Column) -> Column:
    """The aligned blocks of 1, 2, 4, ... numbers that a range consists of, as ``level, at``: two of a level at most."""

    def at(level: Column) -> Column:
        first = lambda k: F.call_function("shiftright", low + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k)
        last = lambda k: F.call_function("shiftright", high + 1, k) - 1
        a, b, split = first(level), last(level), first(level + 1) > last(level + 1)
        one = lambda x: F.struct(level.alias("level"), x.alias("at"))
        return F.array_compact(F.array(F.when((a <= b) & (split | (a % 2 != 0)), one(a)), F.when((a <= b) & (split | (b % 2 == 0)), one(b))))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS)), at)))


def assign_ranges(points: DataFrame, ranges: DataFrame, point: str, low: str = "start", high: str = "end", order: str = "map_idx") -> DataFrame:
    """Adds the columns of the first range (by ``order``) that holds a point; outside all of them they are null.

    A range is cut into aligned blocks of 1, 2, 4, ... numbers, and a distinct point meets the block of each size that
    holds it: an equality join in which the widest range has some sixty rows, however far it reaches. Ranges are integers
    of 32 bits; one that ends before it begins holds nothing.
    """
    blocks = ranges.where(F.col(low) <= F.col(high)).withColumn("_b", F.explode(_dyadic(F.col(low).cast("long"), F.col(high).cast("long"))))
    first = blocks.groupBy("_b").agg(F.min_by(F.struct(*ranges.columns), order).alias("_r"), F.min(order).alias("_o"))
    at = F.transform(F.sequence(F.lit(0), F.lit(_LEVELS)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("_at"), k).alias("at")))
    met = points.select(F.col(point).cast("long").alias("_at")).distinct().select("_at", F.explode(at).alias("_b")).join(first, "_b")
    found = met.groupBy("_at").agg(F.min_by("_r", "_o").alias("_r"))
    return points.join(found, points[point].cast("long") == found["_at"], "left").select(points["*"], *[F.col(f"_r.{c}").alias(c) for c in ranges.columns])


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """``nearest`` for keys with few boxes each, like the pages of a book: all boxes of a key meet."""
    right = right.select(*keys, F.col(right_id).alias("_id"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    near = left.join(right, keys).withColumn("_d", F.abs(F.col("y") - F.col("_y")) + 0.5 * F.abs(F.col("x") - F.col("_x")))
    best = near.where("_d is not null").groupBy(*keys, left_id).agg(F.min(F.struct("_d", "_id")).alias("_b"))
    return best.select(*keys, left_id, F.col("_b._id").alias(right_id), F.col("_b._d").alias("distance"))


#: Boxes of the right side in a cell of the first round, on average.
IN_CELL = 2


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """For every left box the right box with the smallest ``abs(dy) + abs(dx) / 2``; of equal ones the smallest id.

    ``left`` and ``right`` have ``x, y``; both meet within ``keys`` only. Boxes are dealt into square cells of the plane
    ``x / 2, y``, small enough for a few of a key's right boxes each, and a left box meets the nine cells around it. What is
    found no further away than a cell is wide is the nearest; the other left boxes meet cells twice as wide in the next
    round, until none is left. Equal places are one place on either side, however many boxes stand there.
    """
    plane = [(F.col("x").cast("double") / 2).alias("u"), F.col("y").cast("double").alias("v")]
    spots = right.select(*keys, *plane, F.col(right_id).alias("_id")).groupBy(*keys, "u", "v").agg(F.min("_id").alias("_id"))
    spots = stored(spots.where("u is not null and v is not null"), "spots")
    extent = F.greatest(F.max("u") - F.min("u"), F.max("v") - F.min("v"), F.lit(1e-9))
    widths = stored(spots.groupBy(*keys).agg((extent / F.sqrt(F.count("*") / IN_CELL)).alias("wide"), F.min("u").alias("u0"), F.min("v").alias("v0"), F.max("u").alias("u1"), F.max("v").alias("v1")), "widths")
    boxes = left.select(*keys, *plane, F.col(left_id))
    todo = stored(boxes.select(*keys, "u", "v").where("u is not null and v is not null").distinct().join(widths.select(*keys), keys, "left_semi"), "todo")
    found = []
    while not todo.isEmpty():
        step = F.lit(float(2 ** len(found)))
        cell = lambda c, low: F.floor((F.col(c) - F.col(low)) / (F.col("wide") * step))
        cells = spots.join(widths, keys).select(*keys, F.col("u").alias("_u"), F.col("v").alias("_v"), "_id", cell("u", "u0").alias("cu"), cell("v", "v0").alias("cv"))
        at = todo.join(widths, keys)
        around = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.struct((cell("u", "u0") + F.floor(i / 3) - 1).alias("cu"), (cell("v", "v0") + i % 3 - 1).alias("cv")))
        met = at.select(*keys, "u", "v", (F.col("wide") * step).alias("reach"), F.explode(around).alias("c")).select(*keys, "u", "v", "reach", "c.cu", "c.cv").join(cells, [*keys, "cu", "cv"])
        near = F.abs(F.col("v") - F.col("_v")) + F.abs(F.col("u") - F.col("_u"))
        best = met.groupBy(*keys, "u", "v", "reach").agg(F.min(F.struct(near.alias("distance"), "_id")).alias("b"))
        sure = stored(best.where("b.distance <= reach").select(*keys, "u", "v", "b.distance", "b._id"), "nearest")
        found.append(sure)
        todo = stored(todo.join(sure, [*keys, "u", "v"], "left_anti"), "todo")
    if not found:
        return boxes.limit(0).join(spots.limit(0).select(*keys, F.col("_id").alias(right_id)), keys).select(*keys, left_id, right_id, F.lit(0.0).alias("distance"))
    every = reduce(DataFrame.unionByName, found)
    return boxes.join(every, [*keys, "u", "v"]).select(*keys, left_id, F.col("_id").alias(right_id), "distance")


def text_in_boxes(boxes: DataFrame, words: DataFrame, keys: list[str], box_id: str) -> DataFrame:
    """Texts whose centre lies in a box, joined in reading order: ``keys, box_id, text``."""
    inside = boxes.join(words, keys).where("cx between x0 and x1 and cy between y0 and y1")
    return inside.groupBy(*keys, box_id).agg(F.array_join(F.array_sort(F.collect_list(F.struct("cy", "cx", "word")))["word"], " ").alias("text"))


def figure_label(text: str):
    """``1.2`` or ``1.2.3`` from a caption; null if it names no figure."""
    found = []
    for pattern in (FIGURE_CN, FIGURE_EN):
        parts = [F.nullif(F.regexp_extract(text, pattern, i), F.lit("")) for i in (1, 2, 3)]
        found.append(F.when(parts[0].isNotNull(), F.concat_ws(".", *parts)))
    return F.coalesce(*found)


def width_percent(x0: str, x1: str):
    """Share of the page that a crop covers, in per cent with one decimal, half to even; 45 without a box."""
    return F.coalesce(F.bround((F.col(x1) - F.col(x0) + PADDING) / PAGE_WIDTH * 100, 1), F.lit(DEFAULT_WIDTH))


def _taken(figs: pd.DataFrame, refs: pd.DataFrame) -> list[str | None]:
    """Labels of one page's figures, in their order: each takes the nearest one that is left, by ``y``, then by label.

    References that are used are left out by pointers to the next one that is not, upwards and downwards, so that a
    choice looks at two neighbours and the equal ones around them.
    """
    order = np.lexsort((refs["label"].to_numpy(), refs["y"].to_numpy()))
    y, labels = refs["y"].to_numpy(dtype=float)[order], refs["label"].to_numpy()[order]
    up, down = np.arange(len(y) + 1), np.arange(len(y) + 1)  # place k + 1 of ``down`` is reference k, 0 is none
    _, same = np.unique(labels.astype(str), return_inverse=True)
    twins: dict[int, list[int]] = {}
    for k, number in enumerate(same.tolist()):
        twins.setdefault(number, []).append(k)

    def end(pointer: np.ndarray, k: int) -> int:
        root = k
        while pointer[root] != root:
            root = pointer[root]
        while pointer[k] != root:
            pointer[k], k = root, pointer[k]
        return int(root)

    out: list[str | None] = []
    for at in figs["y"].to_numpy(dtype=float).tolist():
        k = int(np.searchsorted(y, at))
        above, below = end(up, k), end(down, k) - 1
        near = [c for c in (above, below) if 0 <= c < len(y) and abs(y[c] - at) < REACH]
        if not near:
            out.append(None)
            continue
        best = min(near, key=lambda c: (abs(y[c] - at), c))
        if best == below:  # the first of equal ones below
            best = end(up, int(np.searchsorted(y, y[below])))
        out.append(labels[best])
        for k in twins[int(same[best])]:
            up[k], down[k + 1] = k + 1, k
    return out


def assign_greedily(figures: DataFrame, references: DataFrame) -> DataFrame:
    """One-to-one labels: figures in the order of ``fig_idx`` take the nearest unused reference of their page within reach.

    ``figures(ch, page, fig_idx, y)``, ``references(ch, page, label, y)``. Each choice depends on the ones before it on the
    same page, so a page is one group: its size is that of a page, whatever the table's. A label that stands twice is
    used up by one choice.
    """

    def pages(rows: pd.DataFrame) -> pd.DataFrame:
        figs = rows[rows["side"] == 0].sort_values("fig_idx", kind="stable")
        return pd.DataFrame({"ch": figs["ch"], "page": figs["page"], "fig_idx": figs["fig_idx"], "label": _taken(figs, rows[rows["side"] == 1])})

    none = F.lit(None)
    both = figures.select("ch", "page", "fig_idx", "y", none.cast("string").alias("label"), F.lit(0).alias("side")).unionByName(
        references.select("ch", "page", none.cast(figures.schema["fig_idx"].dataType).alias("fig_idx"), "y", "label", F.lit(1).alias("side"))
    )
    kinds = {f.name: f.dataType.simpleString() for f in figures.schema}
    return both.groupBy("ch", "page").applyInPandas(pages, f"ch {kinds['ch']}, page {kinds['page']}, fig_idx {kinds['fig_idx']}, label string")


def file_names(index: DataFrame) -> DataFrame:
    """Adds ``name``: by label with a suffix from the second figure of a label on, or numbered if there is none; numbers have two digits at least."""
    nth = F.row_number().over(Window.partitionBy("ch", "label").orderBy("page", "fig_idx"))
    chapter = F.concat(F.lit("ch"), F.format_string("%02d", F.col("ch").cast("long")))
    named = F.concat(chapter, F.lit("_fig"), "label", F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).otherwise(""))
    unnamed = F.concat(chapter, F.lit("_unnamed_"), F.format_string("%02d", nth))
    return index.withColumn("name", F.when(F.col("label").isNotNull(), named).otherwise(unnamed))


def merged_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """A chapter's manual figures stay, its detected ones are replaced; chapters without new figures stay whole."""
    done = new.select("ch").distinct()
    kept = old.where("source = 'manual'").unionByName(old.where("source <> 'manual'").join(done, "ch", "left_anti"))
    manual = old.where("source = 'manual' and label is not null").select("ch", "label").distinct()
    return kept.unionByName(new.join(manual, ["ch", "label"], "left_anti"))


def completeness(captions: DataFrame, index: DataFrame, ignored: DataFrame) -> DataFrame:
    """``ch, label, status`` of figures that only captions (missing) or only the index (extra) know."""
    missing = captions.join(index, ["ch", "label"], "left_anti").join(ignored, ["ch", "label"], "left_anti").select("ch", "label").distinct()
    extra = index.where("label is not null").join(captions, ["ch", "label"], "left_anti").select("ch", "label").distinct()
    return missing.withColumn("status", F.lit("missing")).unionByName(extra.withColumn("status", F.lit("extra")))


def file_faults(files: DataFrame) -> DataFrame:
    """``file, severity, fault`` of crops ``file, width, height, variance``; a null width is an unreadable file."""
    fault = F.when(F.col("width").isNull(), "unreadable").when(F.least("width", "height") < 20, "small").when(F.col("variance") < 50, "blank")
    return files.select("file", F.when(fault == "blank", "warns").otherwise("blocks").alias("severity"), fault.alias("fault")).where("fault is not null")


def first_anchor(lines: DataFrame, anchors: DataFrame) -> DataFrame:
    """``doc_id, fig, line_no``: the line that a figure goes after.

    ``anchors(doc_id, fig, nth, text)``: an earlier candidate wins over an earlier line, a line that begins with the
    text over one that merely holds it.
    """
    met = lines.join(anchors, "doc_id").where(F.contains("line", F.col("text")))
    rank = F.struct(F.when(F.startswith(F.ltrim("line"), F.col("text")), 0).otherwise(1).alias("holds"), "nth", "line_no")
    return met.groupBy("doc_id", "fig").agg(F.min(rank).alias("r")).select("doc_id", "fig", "r.line_no")


def chapter_counts(index: DataFrame) -> DataFrame:
    """``ch, total, named, unnamed``: figures of each chapter."""
    return index.groupBy("ch").agg(F.count("*").alias("total"), F.count("label").alias("named"), (F.count("*") - F.count("label")).alias("unnamed"))


def index_lines(index: DataFrame) -> DataFrame:
    """``ch, nth, line``: a chapter's index as Markdown, labelled figures first, each by page and number."""
    order = Window.partitionBy("ch").orderBy(F.col("label").isNull(), "page", "fig_idx")
    named = F.concat(F.lit("- 图 "), "label", F.lit("：![图 "), "label", F.lit("]("), "file", F.lit(")"))
    unnamed = F.concat(F.lit("- 图(未标号, p"), F.col("page").cast("string"), F.lit(")：![fig]("), "file", F.lit(")"))
    return index.select("ch", F.row_number().over(order).alias("nth"), F.coalesce(named, unnamed).alias("line"))


def detected_pages(detected: DataFrame) -> DataFrame:
    """``ch, pages``: the pages of a chapter that hold a detected figure, in order."""
    return detected.groupBy("ch").agg(F.array_sort(F.collect_set("page")).alias("pages"))
