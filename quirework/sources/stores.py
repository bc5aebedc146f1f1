"""Readers and writers of the stores that documents live in: page scans, Markdown, chapter maps, figure and key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGES = "page int, formulas array<struct<bbox array<int>, cls int, conf double, latex string>>, text array<struct<poly variant, text string, score double>>"


def _file(pattern: str):
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files ``page_N.json`` of any number of books (a book is the folder): ``book, page, formulas, text``.

    Broken files give a page without text. Only what a query uses of the nested columns is parsed out.
    """
    rows = spark.read.schema(PAGES).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    number = _file(r"page_(\d+)\.json$").cast("int")
    return rows.select(F.coalesce(_file(r"([^/]+)/page_\d+\.json$"), F.lit("")).alias("book"), F.coalesce("page", number).alias("page"), "formulas", "text")


def blocks(scans: DataFrame, no_place: float = 0.0) -> DataFrame:
    """``book, page, block, text, x, y``: text blocks in reading order.

    ``poly`` is a flat list of eight numbers or a list of points; a block without one stands at ``no_place``. ``block``
    numbers the blocks of a page by height, blocks of equal height in the order of the file.
    """
    rows = scans.select("book", "page", F.posexplode("text").alias("nth", "b"))
    at = lambda path: F.try_variant_get("b.poly", path, "double")
    rows = rows.withColumns({
        "text": F.btrim("b.text"),
        "x": F.coalesce(at("$[0][0]"), at("$[0]"), F.lit(no_place)),
        "y": F.coalesce(at("$[0][1]"), at("$[1]"), F.lit(no_place)),
    })
    rows = rows.where("text <> ''")
    order = F.row_number().over(Window.partitionBy("book", "page").orderBy("y", "nth"))
    return rows.withColumn("block", order).select("book", "page", "block", "text", "x", "y")


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """Chapter files: ``doc_id`` (the path), ``file``, ``text``."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def chapter_of(file: str):
    """Chapter number in ``第N章_*.md`` or ``ChapterN_*.md``; null for files that are split already."""
    name = F.col(file)
    number = F.coalesce(F.nullif(F.regexp_extract(name, r"^第(\d+)章_[^_]*\.md$", 1), F.lit("")), F.nullif(F.regexp_extract(name, r"^Chapter(\d+)_[^_]*\.md$", 1), F.lit("")))
    return number.cast("int")


def chapter_map(spark: SparkSession, path: str) -> DataFrame:
    """``map_idx, ch, start, end, scheme`` from any of the three shapes of the file; ids that are no number are left out."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    as_map = F.transform_values(F.try_variant_get("v", "$", "map<string, variant>"), lambda k, x: x)
    listed = F.coalesce(F.try_variant_get("v", "$.chapters", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"))
    from_list = whole.select(F.posexplode(listed).alias("map_idx", "c"), F.lit(None).cast("string").alias("id"))
    entries = F.map_entries(as_map)
    from_map = whole.where(listed.isNull()).select(F.posexplode(entries).alias("map_idx", "e")).select("map_idx", F.col("e.value").alias("c"), F.col("e.key").alias("id"))
    rows = from_list.unionByName(from_map)
    get = lambda *names, kind="int": F.coalesce(*[F.try_variant_get("c", f"$.{n}", kind) for n in names])
    ch = F.coalesce(F.col("id"), get("num", "ch", kind="string")).try_cast("int")
    rows = rows.select("map_idx", ch.alias("ch"), get("start_page", "pdf_start", "start").alias("start"), get("end_page", "pdf_end", "end").alias("end"), F.coalesce(get("scheme", kind="string"), F.lit("three-level")).alias("scheme"))
    return rows.where("ch is not null")


def ignored_keys(spark: SparkSession, path: str) -> DataFrame:
    """``ch, key, reason`` from ``ignore_chN.json``: a list of keys, or keys with reasons."""
    from ..functions.text import normal_key

    whole = spark.read.text(path, wholetext=True).select(_file(r"_ch(\d+)\.json$").try_cast("int").alias("ch"), F.try_parse_json("value").alias("v"))
    listed = whole.select("ch", F.explode(F.try_variant_get("v", "$", "array<string>")).alias("key"), F.lit(None).cast("string").alias("reason"))
    named = whole.where(F.try_variant_get("v", "$", "array<string>").isNull()).select("ch", F.explode(F.try_variant_get("v", "$", "map<string, string>")).alias("key", "reason"))
    return listed.unionByName(named).select("ch", normal_key(F.col("key")).alias("key"), "reason")


def figure_rows(spark: SparkSession, path: str, columns: str = "chapter int, page int, fig_idx int, label string, bbox array<int>, conf double, file string, caption string, cap_text string, source string") -> DataFrame | None:
    """Detected or indexed figures: None if no such file is there, no rows if its list is empty."""
    return spark.read.schema(columns).option("multiLine", True).json(path) if _there(spark, path) else None


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def ignored_figures(spark: SparkSession, path: str) -> DataFrame:
    """``ch, label, reason`` of figures from ``ignore_fig_chN.json``, labels without blanks."""
    from ..functions.text import normal_figure

    return ignored_keys(spark, path).select("ch", normal_figure(F.col("key")).alias("label"), "reason")


def manual_figures(spark: SparkSession, path: str) -> DataFrame:
    """``ch, label, page, bbox, rotate, caption`` from ``figure_manual_chN.json``; broken files give no rows."""
    whole = spark.read.text(path, wholetext=True).select(_file(r"_ch(\d+)\.json$").try_cast("int").alias("ch"), F.try_parse_json("value").alias("v"))
    rows = whole.select("ch", F.explode(F.try_variant_get("v", "$", "map<string, variant>")).alias("label", "f"))
    get = lambda name, kind: F.try_variant_get("f", f"$.{name}", kind).alias(name)
    return rows.select("ch", "label", get("page", "int"), get("bbox", "array<int>"), get("rotate", "int"), get("caption", "string"))


def embed_overrides(spark: SparkSession, path: str) -> DataFrame:
    """``file, anchors, is_proof`` from ``figure_embed_overrides.json``."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    rows = whole.select(F.explode(F.try_variant_get("v", "$", "map<string, variant>")).alias("file", "o"))
    return rows.select("file", F.coalesce(F.try_variant_get("o", "$.anchors", "array<string>"), F.array().cast("array<string>")).alias("anchors"), F.coalesce(F.try_variant_get("o", "$.is_proof", "boolean"), F.lit(False)).alias("is_proof"))


def write_lines(lines: DataFrame, path: str, buckets: int = 64) -> None:
    """Documents as ``doc_id, text`` with line feeds between lines and one at the end, in ``buckets`` folders by a hash of the id."""
    text = lines.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("line_no", "line")))["line"], "\n").alias("text"))
    text = text.select("doc_id", F.when(F.endswith("text", F.lit("\n")), F.col("text")).otherwise(F.concat("text", F.lit("\n"))).alias("text"))
    text.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_pages(scans: DataFrame, path: str) -> None:
    scans.write.mode("overwrite").partitionBy("book", "page").parquet(path)


def write_figures(rows: DataFrame, path: str) -> None:
    """Detected or indexed figures as JSON lines, one folder a chapter; a chapter that is written again is replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ch").json(path)
