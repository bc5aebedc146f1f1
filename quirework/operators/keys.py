"""Keys that a summary contains, against keys that its source contains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import canonical_label, normal_key, strip


def md_keys(lines: DataFrame, scheme: str = "three-level") -> DataFrame:
    """``doc_id, key, entry``: every key once, ``entry`` if it heads a bold entry and not merely gets a mention."""
    if scheme == "three-level":
        bold = F.transform(F.regexp_extract_all("line", F.lit(P.ENTRY), F.lit(1)), normal_key)
        said = F.transform(F.regexp_extract_all("line", F.lit(f"({P.KEY})"), F.lit(1)), normal_key)
    else:
        name = lambda k: F.concat(canonical_label(F.regexp_extract(k, r"^([^\d\s]+)", 1)), F.regexp_extract(k, r"(\d+\.\d+)", 1))
        bold = F.transform(F.regexp_extract_all("line", F.lit(P.LABELLED_ENTRY), F.lit(1)), name)
        said = F.transform(F.regexp_extract_all("line", F.lit(P.LABELLED_MENTION), F.lit(1)), name)
    both = F.concat(F.transform(bold, lambda k: F.struct(k.alias("key"), F.lit(True).alias("entry"))), F.transform(said, lambda k: F.struct(k.alias("key"), F.lit(False).alias("entry"))))
    return lines.select("doc_id", F.explode(both).alias("k")).groupBy("doc_id", F.col("k.key").alias("key")).agg(F.max("k.entry").alias("entry"))


def compare(items: DataFrame, keys: DataFrame, ignored: DataFrame) -> DataFrame:
    """``doc_id, key, status`` of ``items(doc_id, key)`` against ``md_keys``: missing, mentioned, extra or ignored."""
    wanted = items.select("doc_id", "key").distinct().join(ignored.select("doc_id", "key").distinct().withColumn("noise", F.lit(True)), ["doc_id", "key"], "left")
    both = wanted.withColumn("wanted", F.lit(True)).join(keys, ["doc_id", "key"], "full")
    status = (
        F.when(F.col("noise"), "ignored")
        .when(F.col("wanted") & F.col("entry").isNull(), "missing")
        .when(F.col("wanted") & ~F.col("entry"), "mentioned")
        .when(F.col("wanted").isNull(), "extra")
    )
    return both.select("doc_id", "key", status.alias("status")).where("status is not null")


def suppressed(messages: DataFrame, ignored: DataFrame) -> DataFrame:
    """Messages ``doc_id, message_id, keys`` that are left when every key of a message may be ignored."""
    named = messages.select("doc_id", "message_id", F.explode("keys").alias("key")).distinct()
    left = named.join(ignored.select("doc_id", "key").distinct(), ["doc_id", "key"], "left_anti").select("doc_id", "message_id").distinct()
    return messages.where("size(keys) = 0").unionByName(messages.join(left, ["doc_id", "message_id"], "left_semi"))


def section_numbers(lines: DataFrame) -> DataFrame:
    """Highest item number of each section in bold lines: ``doc_id, section, high``."""
    number = F.explode(F.regexp_extract_all("line", F.lit(r"(\d{1,3}\.\d{1,3}[.\-·]\d{1,3})"), F.lit(1))).alias("key")
    rows = lines.where(F.contains("line", F.lit("**"))).select("doc_id", number)
    parts = F.split(F.regexp_replace("key", "[-·]", "."), r"\.", -1)
    rows = rows.select("doc_id", parts[1].cast("int").alias("section"), parts[2].cast("int").alias("n")).where("n > 0")
    return rows.groupBy("doc_id", "section").agg(F.max("n").alias("high"))


def section_state(source: DataFrame, summary: DataFrame, headings: DataFrame) -> DataFrame:
    """``doc_id, section, source_high, summary_high, state``: missing heading, tail gap (up to 5) or suspect (more)."""
    out = source.withColumnRenamed("high", "source_high").join(summary.withColumnRenamed("high", "summary_high"), ["doc_id", "section"], "left")
    out = out.join(headings.select("doc_id", "section").distinct().withColumn("headed", F.lit(True)), ["doc_id", "section"], "left").na.fill(0, ["summary_high"])
    gap = F.col("source_high") - F.col("summary_high")
    state = F.when(F.col("headed").isNull(), "missing").when(gap > 5, "suspect").when(gap > 0, "tail")
    return out.select("doc_id", "section", "source_high", "summary_high", state.alias("state")).where("state is not null")


def upsert(base: DataFrame, overrides: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``base`` with the rows of ``overrides`` in place of or beside its own; of several overrides of a key the last by ``order``."""
    rows = base.withColumn("_priority", F.lit(1)).unionByName(overrides.withColumn("_priority", F.lit(0)))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_priority", *[F.desc(c) for c in order]))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth", "_priority")


def with_ignored(ignored: DataFrame, more: DataFrame, reason: str = "added") -> DataFrame:
    """``ch, key, reason`` of an ignore list with the keys of ``more(ch, key)`` that it does not hold yet."""
    new = more.select("ch", normal_key(strip(F.col("key"))).alias("key")).where("key <> ''").distinct()
    return ignored.select("ch", "key", "reason").unionByName(new.join(ignored.select("ch", "key"), ["ch", "key"], "left_anti").withColumn("reason", F.lit(reason)))


def without_ignored(ignored: DataFrame, gone: DataFrame) -> DataFrame:
    """An ignore list without the keys of ``gone(ch, key)``."""
    return ignored.join(gone.select("ch", normal_key(strip(F.col("key"))).alias("key")).distinct(), ["ch", "key"], "left_anti")


def section_only_keys(lines: DataFrame) -> DataFrame:
    """``doc_id, key`` of the bold entries of books whose keys have no chapter."""
    found = F.explode(F.regexp_extract_all("line", F.lit(P.SECTION_ONLY_ENTRY), F.lit(0))).alias("said")
    part = lambda i: F.regexp_extract("said", P.SECTION_ONLY_ENTRY, i)
    return lines.select("doc_id", found).select("doc_id", F.concat(part(1), part(2).cast("int").cast("string"), F.lit("."), part(3).cast("int").cast("string")).alias("key")).distinct()


def section_only_state(items: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id, key, status``: items of a source that its summary lacks (missing) and entries that no source has (extra)."""
    wanted, held = items.select("doc_id", "key").distinct(), keys.select("doc_id", "key")
    missing = wanted.join(held, ["doc_id", "key"], "left_anti").withColumn("status", F.lit("missing"))
    return missing.unionByName(held.join(wanted, ["doc_id", "key"], "left_anti").withColumn("status", F.lit("extra")))
