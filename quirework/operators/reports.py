"""Chapters as files, and roll-ups of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ratio
from ..plans.lines import forward

#: Characters beyond which a chapter is split.
SPLIT = 30_000


def oversized(docs: DataFrame, most: int = SPLIT) -> DataFrame:
    return docs.where(F.length("text") > most).select("doc_id", F.length("text").alias("n_chars"))


def sections(lines: DataFrame, heading: str = r"^##\s") -> DataFrame:
    """``doc_id, section, title, body``: lines under each heading, joined in order; what stands before the first goes with it."""
    opens = F.col("line").rlike(heading)
    rows = lines.withColumn("section", F.greatest(F.sum(opens.cast("int")).over(forward().rowsBetween(Window.unboundedPreceding, 0)), F.lit(1)))
    rows = rows.withColumn("opens", opens)
    return rows.groupBy("doc_id", "section").agg(
        F.min_by("line", F.when(F.col("opens"), F.col("line_no"))).alias("title"),
        F.array_join(F.array_sort(F.collect_list(F.struct("line_no", "line")))["line"], "\n").alias("body"),
    )


def split_chapters(docs: DataFrame, lines: DataFrame, most: int = SPLIT) -> DataFrame:
    """Sections of documents beyond ``most`` characters only."""
    return sections(lines.join(oversized(docs, most).select("doc_id"), "doc_id", "left_semi"))


def rollup(reports: DataFrame) -> DataFrame:
    """Totals of ``book, md_count, verify_pass`` where ``verify_pass`` is ``passed/total``; broken ratios count as none."""
    rows = reports.withColumn("r", ratio(F.col("verify_pass")))
    return rows.agg(
        F.count("*").alias("books"), F.coalesce(F.sum("md_count"), F.lit(0)).alias("files"), F.coalesce(F.sum("r.passed"), F.lit(0)).alias("passed"), F.coalesce(F.sum("r.total"), F.lit(0)).alias("total"),
        F.count_if(F.col("r.passed") < F.col("r.total")).alias("failing"), F.count_if(F.col("r.passed").isNull() | F.col("r.total").isNull()).alias("broken"),
    )


def languages(files: DataFrame) -> DataFrame:
    """Chinese and English file of each chapter side by side: ``ch, cn, en``."""
    number = F.coalesce(F.nullif(F.regexp_extract("file", r"^第(\d+)章", 1), F.lit("")), F.nullif(F.regexp_extract("file", r"^Chapter(\d+)_", 1), F.lit(""))).cast("int")
    rows = files.withColumn("ch", number).where("ch is not null").withColumn("cn", F.startswith("file", F.lit("第")))
    return rows.where("cn").select("ch", F.col("file").alias("cn")).join(rows.where("not cn").select("ch", F.col("file").alias("en")), "ch", "full")


def oversized_chapters(files: DataFrame) -> DataFrame:
    """``book, ch, lang, n_chars`` of all languages of a chapter that is too long in any of them: all of them are split alike.

    ``files(book, ch, lang, text)``; of several files of a language the longest counts, a null text is none.
    """
    sizes = files.where("text is not null").groupBy("book", "ch", "lang").agg(F.max(F.length("text")).alias("n_chars"))
    most = F.max("n_chars").over(Window.partitionBy("book", "ch"))
    return sizes.withColumn("most", most).where(F.col("most") > SPLIT).drop("most")
