"""Queries over the driver's tables, one for each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, decontam, exact_search, licenses, media, phrases, quality, substring_dedup, toxicity, warc
from .jaccard_join import jaccard_components
from .oracles import ORACLES
from .samples import held_out
from .shared import keep, read


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _hex(digest) -> str:
    return F.lower(F.sha2(digest, 256))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.LEAST).cast("int").alias("predicted"))


def op5_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), path or vocabulary_path()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _hex(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")).alias("ids_sha256"),
        _hex(F.encode("text", "utf-8")).alias("decoded_sha256"),
    )


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _hex(F.array_join("items", ",").cast("binary")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.load(media.store(read(spark, sf_dir, "documents"))).select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        _hex("payload").alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        _hex("media").alias("media_sha256"),
        F.lower(F.hex("hash")).alias("feature"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = keep(warc.chunk_table(read(spark, sf_dir, "pages")), "warc")
    return warc.read_table(archive).select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    back = chat.read_chat(chat.format_chat(rows.unionByName(own)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _hex(said.cast("binary")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        _hex(F.col("loss_text").cast("binary")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(read(spark, sf_dir, "documents"))
    some = F.size("base_starts") > 0
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.when(some, F.array_min("base_starts")).cast("long").alias("first_word"),
        F.when(some, F.array_max("base_starts")).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_products(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0).drop("query")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_substring_dedup, op3_jaccard_join, op4_quality, op5_bpe, op6_decontam, op7_media, op8_warc, op9_chat, op10_licenses, op11_centroids, op12_exact_search, op13_phrases)}

__all__ = ["ORACLES", "QUERIES", "vocabulary_path"]
