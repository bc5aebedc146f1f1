"""Line tables and the window columns that rules share.

All windows run within one document, in line order: one exchange by document, one sort for each direction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import matched, quoted, strip


def forward() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("line_no")


def rows_before() -> WindowSpec:
    return forward().rowsBetween(Window.unboundedPreceding, -1)


def rows_through() -> WindowSpec:
    return forward().rowsBetween(Window.unboundedPreceding, 0)


def rows_after() -> WindowSpec:
    """Reading backwards, the rows behind a line are the ones after it; no frame has to look ahead to its end."""
    return Window.partitionBy("doc_id").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)


#: Characters of the texts that a task gets, on average: with its context a line is several times as long.
TASK_CHARS = 4 << 20


def shares(docs: DataFrame, text: str = "text", size: int = TASK_CHARS) -> int | None:
    """Tasks that the texts need; none if Spark takes no fewer by itself.

    Many shuffle partitions are no help: Spark joins small ones until they hold 64 MB, so only a table of a task a core is left to it.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    tasks = -(-chars // size)
    return tasks if tasks > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism) else None


def dealt(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = TASK_CHARS) -> DataFrame:
    """``docs`` by ``key`` over as many tasks as their texts need, if Spark might take fewer.

    Windows by document find their rows together then: whole texts travel, not their lines, and no task grows with the table.
    """
    tasks = shares(docs, text, size)
    return docs.repartition(tasks, key) if tasks else docs


def spread(docs: DataFrame) -> DataFrame:
    """``docs`` over a task a core, if a read of its files gives fewer tasks; a larger table stays where it is."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def md_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, text`` -> ``doc_id, line_no, line``; line numbers begin at 1, a null text has no lines."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
    return lines.select("doc_id", (F.col("pos") + 1).alias("line_no"), "line")


def parted(lines: DataFrame) -> DataFrame:
    """The lines that a step made, sorted before the next step's columns are worked out.

    Steps of one stage share their generated code; the sort cuts it into pieces small enough that the JVM compiles them.
    The next step's windows need this order in any case.
    """
    return lines.sortWithinPartitions("doc_id", "line_no")


def before(value: Column) -> Column:
    """The last value before a line that is not null."""
    return F.last(value, ignorenulls=True).over(rows_before())


def after(value: Column) -> Column:
    """The next value after a line that is not null."""
    return F.last(value, ignorenulls=True).over(rows_after())


def latch(on: Column, off: Column) -> Column:
    """Whether the last event before a line switched on; ``on`` wins if a line is both."""
    return F.coalesce(before(F.when(on, True).when(off, False)), F.lit(False))


def count_before(what: Column) -> Column:
    return F.coalesce(F.sum(what.cast("int")).over(rows_before()), F.lit(0))


def line_context(lines: DataFrame) -> DataFrame:
    """Adds the stripped line, its kind, and the lines around it."""
    lines = lines.withColumn("t", strip(F.col("line")))
    lines = lines.withColumns({
        "blank": F.col("t") == "",
        "bq": F.startswith("line", F.lit(">")),
        "bqi": F.startswith("t", F.lit(">")),
        "head": matched(F.col("line"), P.HEADING),
        "dash": F.col("t") == "---",
    })
    return lines.withColumns({
        "p1": F.lag("line").over(forward()),
        "n1": F.lead("line").over(forward()),
        "pnb": before(F.when(~F.col("blank"), F.col("line"))),
        "nnb": after(F.when(~F.col("blank"), F.col("line"))),
    })


def is_quoted(text: str) -> Column:
    return F.coalesce(quoted(F.col(text)), F.lit(False))
