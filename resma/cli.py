"""Command line: ``python -m resma.cli list``, ``run NAME --data FOLDER [--out FOLDER]``, ``status --data FOLDER``, ``validate --data FOLDER``.

Exit codes: 0 done, 1 faulty lines found (``validate``), 2 wrong use or unknown query.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from resma import problems, queries
from resma.operators import catalog, rejects
from resma.sources.tables import table


def known() -> dict:
    """All queries by name; those of the text subpackage where it is there."""
    try:
        from resma.llm import queries as llm
    except ImportError:
        return {**queries.QUERIES, **problems.QUERIES}
    return {**queries.QUERIES, **problems.QUERIES, **llm.QUERIES}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="resma", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run")
    run.add_argument("name")
    run.add_argument("--out", help="folder for Parquet files; without it the first rows are shown")
    for p in (run, commands.add_parser("status"), commands.add_parser("validate")):
        p.add_argument("--data", required=True)
    try:
        asked = parser.parse_args(arguments)
    except SystemExit as stop:
        return 2 if stop.code else 0
    if asked.command == "list":
        print("\n".join(sorted(known())))
        return 0
    if asked.command == "run" and asked.name not in known():
        print(f"no query named {asked.name}", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("resma").getOrCreate()
    if asked.command == "run":
        frame = known()[asked.name](spark, asked.data)
        if asked.out:
            frame.write.mode("overwrite").parquet(asked.out)
        else:
            frame.show(20, truncate=80)
        return 0
    if asked.command == "status":
        catalog.status_counts(table(spark, asked.data, "scrape_results"), "status").show(1000, truncate=False)
        return 0
    faulty = rejects.rejected_records(table(spark, asked.data, "dataset_records").select("dataset_id", "line_number", "raw_json"))
    counts = catalog.status_counts(faulty, "reason")
    counts.show(1000, truncate=False)
    return 1 if counts.where("status = 'total' AND n > 0").count() else 0


if __name__ == "__main__":
    sys.exit(main())
