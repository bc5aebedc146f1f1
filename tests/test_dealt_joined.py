"""Documents keep their tasks where Spark would join the partitions of a shuffle."""

from pyspark.sql import functions as F

from quirework.plans.lines import dealt, line_context, md_lines


def test_many_shuffle_partitions_do_not_join_the_texts(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abc\n"), 50).alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert line_context(md_lines(dealt(docs, size=chars // 40 + 1))).rdd.getNumPartitions() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
