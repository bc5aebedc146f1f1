"""``python -m quirework list | run QUERY TABLES OUT | gate TABLES OUT [--disable CODE ...] [--scheme NAME] [--ignore FILE] [--manual FILE] [--fix FOLDER]``.

Results are written as Parquet. ``--ignore`` is a JSON file of ``doc_id, key`` rows, ``--manual`` one of ``ch, label`` rows; ``--fix``
writes the repaired lines of all documents.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(args: list[str], spark: SparkSession | None = None) -> int:
    """0; of ``gate`` 1 if any document does not pass."""
    from .operators import rules
    from .operators.registry import structure
    from .queries import QUERIES, lines_of, read
    from .queries_repairs import layers

    parser = argparse.ArgumentParser(prog="quirework", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="one query over a folder of tables")
    run.add_argument("query", choices=sorted(QUERIES))
    gate = commands.add_parser("gate", help="documents that a layer blocks")
    gate.add_argument("--disable", nargs="*", default=[], metavar="CODE", help="codes of layers and of structure rules to leave out")
    gate.add_argument("--scheme", choices=["three-level", "two-level"], default="three-level", help="how keys are written")
    gate.add_argument("--ignore", metavar="FILE", help="keys that need not be there")
    gate.add_argument("--manual", metavar="FILE", help="figures known by hand")
    gate.add_argument("--fix", metavar="FOLDER", help="where repaired lines go")
    for command in (run, gate):
        command.add_argument("tables")
        command.add_argument("out")
    given = parser.parse_args(args)
    if given.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("quirework").getOrCreate()
    if given.command == "run":
        QUERIES[given.query](spark, given.tables).write.mode("overwrite").parquet(given.out)
        return 0
    ignored = spark.read.schema("doc_id long, key string").json(given.ignore) if given.ignore else None
    manual = spark.read.schema("ch int, label string").json(given.manual) if given.manual else None
    if given.fix:
        structure().repaired(lines_of(spark, given.tables), disabled=given.disable).write.mode("overwrite").parquet(given.fix)
    rules.gate(read(spark, given.tables, "documents"), layers(spark, given.tables, given.disable, given.scheme, ignored, manual)).write.mode("overwrite").parquet(given.out)
    return int(not spark.read.parquet(given.out).where("not passed").isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
