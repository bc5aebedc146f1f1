"""Incremental work over arriving page files: batches, readiness of chapters, idempotent figure stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Files that one batch takes at most.
BATCH = 50


def arriving(spark: SparkSession, path: str, schema: str, files: int = BATCH, source: str = "parquet") -> DataFrame:
    """A stream of the files in ``path``, ``files`` of them a batch; the checkpoint replaces a resume point."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(source).load(path)


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works off what has arrived, batch by batch, and stops."""
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that replaces its own output when a batch is run again."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def ready(chapters: DataFrame, done: DataFrame) -> DataFrame:
    """Chapters whose every page is in the ledger ``done(book, page)``, figures or not: ``book, ch, pages``."""
    pages = chapters.select("book", "ch", F.col("start"), F.col("end"))
    met = pages.join(done.select("book", "page").distinct(), "book").where("page between start and end")
    counts = met.groupBy("book", "ch", "start", "end").agg(F.count("*").alias("pages"))
    return counts.where("pages = `end` - start + 1").select("book", "ch", "pages")


def progressed(chapters: DataFrame, done: DataFrame) -> DataFrame:
    """Chapters that the highest page so far has passed: a watermark on page numbers."""
    top = done.groupBy("book").agg(F.max("page").alias("top"))
    return chapters.join(top, "book").where("`end` <= top").select("book", "ch")


def stored(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("page", "fig_idx")) -> DataFrame:
    """``old`` with the rows of ``new`` in place of its own: detections of a page that is run again replace the first ones."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").select(old.columns).unionByName(new)
