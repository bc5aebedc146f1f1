"""A training-data pipeline: each stage works on all rows that its predecessor kept.

Defined cases: rows with a null ``doc_id`` pass every stage (they have no copies to be one of, and are judged by their
own text elsewhere). A null text scores as an empty one, links with nothing, holds no passage and no words, and encodes
to no ids. Repeated ids stay repeated but for rows whose id the Jaccard join drops. Very long texts are read whole. Extra
columns, whatever their names, stay until the last stage. An empty ``documents`` gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import bpe, decontam, quality, substring_dedup
from quirework.llm.jaccard_join import jaccard_components
from quirework.llm.queries import vocabulary_path
from quirework.llm.shared import keep, read


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below the classifier's limit."""
    return quality.accepted(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies; rows without an id stay."""
    more = jaccard_components(docs).where("component_id <> doc_id").select("doc_id")
    return docs.join(more, docs["doc_id"].cast("long") == more["doc_id"], "left_anti").select(docs.columns)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every repeated line and sentence but its first occurrence."""
    return substring_dedup.remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold a window of a benchmark item."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """-> ``doc_id, n_tokens, ids, decoded_sha256``: the ids of each text, and the digest of the text that they decode to."""
    both = bpe.round_trip(docs, vocabulary_path())
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding", bpe_encoding),
]

#: A trained classifier and BPE have no SQL; ``tests/llm/test_pipeline.py`` holds the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage after the other over ``documents``; what a stage returns is written to the shared folder and reread."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = keep(docs, name.replace(" ", "-"))
    return docs
