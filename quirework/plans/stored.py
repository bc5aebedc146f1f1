"""Tables that several branches of one plan read: written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of sessions on one machine that name none, by the session's application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session on one machine (master ``local``) without it gets a folder of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='quirework-')}"
    return _LOCAL[context.applicationId]


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a written table: computed once, whatever reads it; lost executors cost nothing. Gone when the driver's JVM ends."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/quirework/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    _leaves(spark, path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_tables(spark: SparkSession, **tables: DataFrame) -> str:
    """A folder with ``tables`` as Parquet, as queries read them. Gone when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/quirework/tables-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    _leaves(spark, folder)
    return folder


def _leaves(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
