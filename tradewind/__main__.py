"""Command line: ``python -m tradewind run|check|counts|sql``; the exit code is 1 when a check fails."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tradewind.operators.quality import summary
from tradewind.pipeline import MARTS, WAREHOUSE, run_pipeline
from tradewind.plans.checks import quality_report
from tradewind.session import tune
from tradewind.sources.csv_load import CsvLoad
from tradewind.sources.raw import read_database, read_parquet_folder
from tradewind.sources.sink import row_counts
from tradewind.sql import Sql


def _arguments(words: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradewind", description="Commerce warehouse, marts and checks on Spark")
    parser.add_argument("--warehouse", default="warehouse", help="database of the star schema")
    parser.add_argument("--marts", default="marts", help="database of the marts")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="build everything from raw tables")
    source = run.add_mutually_exclusive_group(required=True)
    for kind in ("csv", "parquet", "database"):
        source.add_argument(f"--{kind}", help="folder or database of the raw tables")
    run.add_argument("--buckets", type=int, default=0)
    run.add_argument("--by-month", action="store_true", help="store the facts by month of purchase")
    run.add_argument("--parallel", type=int, default=4, help="tables built at the same time")
    run.add_argument("--run-id", help="go on with the run of this name: its tables that are stored are not built again")
    run.add_argument("--stop-on-failed-checks", action="store_true")
    commands.add_parser("check", help="run the quality checks on the stored warehouse")
    commands.add_parser("counts", help="rows of every stored table")
    commands.add_parser("sql", help="run a statement").add_argument("statement")
    return parser.parse_args(words)


def _print_report(report) -> bool:
    """The report, one line a check; whether all passed."""
    for row in report.orderBy("status", "check").collect():
        print(f"{row['status']:<5} {row['check']:<32} {row['violations']:>9}  {row['description']}")
    counts = summary(report).first()
    print(f"{counts['passed']} passed, {counts['failed']} failed out of {counts['total']} checks")
    return counts["all_passed"]


def main(words: list[str] | None = None, spark: SparkSession | None = None) -> int:
    arguments = _arguments(words)
    spark = tune(spark or SparkSession.builder.appName("tradewind").getOrCreate())
    def tables(database: str, names: tuple[str, ...]):
        return {name: spark.table(f"`{database}`.`{name}`") for name in names}

    if arguments.command == "run":
        if arguments.csv:
            raw = CsvLoad(spark, arguments.csv)
        else:
            raw = read_parquet_folder(spark, arguments.parquet) if arguments.parquet else read_database(spark, arguments.database)
        try:
            built = run_pipeline(
                spark,
                raw,
                arguments.warehouse,
                arguments.marts,
                buckets=arguments.buckets,
                stop_on_failed_checks=arguments.stop_on_failed_checks,
                parallel=arguments.parallel,
                run_id=arguments.run_id,
                by_month=arguments.by_month,
            )
        except ValueError as failed:
            print(failed, file=sys.stderr)
            return 1
        for row in row_counts({**built.warehouse, **built.marts}).collect():
            print(f"{row['table_name']}: {row['n']:,}")
        return 0 if _print_report(built.quality) else 1
    if arguments.command == "check":
        return 0 if _print_report(quality_report(tables(arguments.warehouse, WAREHOUSE))) else 1
    if arguments.command == "counts":
        for row in row_counts(tables(arguments.warehouse, WAREHOUSE) | tables(arguments.marts, MARTS)).collect():
            print(f"{row['table_name']}: {row['n']:,}")
        return 0
    layers = Sql(spark, warehouse=arguments.warehouse, marts=arguments.marts)
    for row in layers.fetch(arguments.statement):
        print("\t".join("" if value is None else str(value) for value in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
