"""Small helpers that several training-data operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Folders of sessions on one machine that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session, which is left as it is.

    Where it is unset, a session on one machine (master ``local``) gets a temporary folder; on a cluster this raises,
    since executors could not see a folder of the driver's machine.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='quirework-')}"
    return _LOCAL[context.applicationId]


def _file(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def store(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet into the shared folder -> its path. The files go when the driver's JVM ends, if not before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quirework/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, at = _file(spark, path)
    files.deleteOnExit(at)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete what ``store`` wrote, once nothing reads it any more."""
    files, at = _file(spark, path)
    files.delete(at, True)
    files.cancelDeleteOnExit(at)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends here. The files outlive lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, label))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)`` of longs -> ``(node, component)``.

    ``component`` is the smallest node that can be reached; nodes without an edge do not appear.
    Alternates the large-star and small-star steps of Kiveris et al. (2014), each a grouped minimum and a
    join, until a round changes nothing. Edges point from the larger node to the smaller one, so the smallest neighbour
    of a node is found from the edges that leave it; the many edges that enter a hub are never grouped, and the table
    of minima is joined to them as a table of its own size. Each round writes its edges to the shared folder and counts
    them on the way, so the plan does not grow, nothing but two numbers a round reaches the driver, and the files of
    the round before are deleted.
    """
    spark = edges.sparkSession
    path, seen = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label), None
    while True:
        now = spark.read.schema("a long, b long").parquet(path)
        minima = store(now.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("low")), f"{label}-minima")
        large = now.join(spark.read.schema("b long, low long").parquet(minima), "b", "left").select("a", F.coalesce("low", "b").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("b", "low"), F.struct(F.col("a").alias("b"), "low"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        told = Observation()
        counted = small.observe(told, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
        old, path = path, store(counted, label)
        for done in (old, minima):
            forget(spark, done)
        state = (told.get["n"], told.get["sum"])
        if state == seen or not state[0]:
            now = spark.read.schema("a long, b long").parquet(path)
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = state
