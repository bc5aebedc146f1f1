"""The bounded sample of labelled documents that classifiers learn from, and the fold that they never see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that no classifier learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, text, label`` of at most ``most`` documents of each class, picked by a hash of their id.

    Only ids travel to pick the sample. It is broadcast (``2 * most`` ids) to read its texts in one scan. Of several texts
    of an id the one with the smallest SHA-256 digest counts (null as an empty one), whatever the order of the rows.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    said = F.coalesce("text", F.lit(""))
    one = F.min(F.struct(F.sha2(said.cast("binary"), 256), said.alias("text")))["text"].alias("text")
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "text", "label")
