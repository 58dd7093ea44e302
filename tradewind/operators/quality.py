"""Generic data-quality checks: row predicates, uniqueness and foreign keys.

A check counts violations. All row predicates of a table are counted in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    description: str = ""
    expect_zero: bool = True


@dataclass(frozen=True)
class RowCheck(Check):
    """Rows for which ``violation()`` is true; NULL is no violation."""

    violation: Callable[[], Column] = None


@dataclass(frozen=True)
class UniqueCheck(Check):
    """Key values that occur more than once."""

    key: str = ""


@dataclass(frozen=True)
class ForeignKeyCheck(Check):
    """Rows whose key has no parent; a NULL key has none, unless exempt."""

    key: str = ""
    parent: str = ""
    parent_key: str = ""
    nulls_exempt: bool = False


def not_null(name: str, table: str, column: str, description: str) -> RowCheck:
    return RowCheck(name, table, description, violation=lambda: F.col(column).isNull())


def count_row_violations(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """(check, violations) for all the row checks of one table, from one scan."""
    counted = df.agg(*[F.count_if(c.violation()).alias(c.name) for c in checks])
    return counted.unpivot([], [c.name for c in checks], "check", "violations")


def violations(table: str, checks: list[Check]) -> dict[str, Column]:
    """The row checks of a table as aggregates, to be counted by whoever passes over its rows anyway."""
    return {c.name: F.count_if(c.violation()) for c in checks if isinstance(c, RowCheck) and c.table == table}


def count_duplicates(df: DataFrame, check: UniqueCheck) -> DataFrame:
    repeated = df.groupBy(check.key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return _labelled(repeated.agg(F.count("*").alias("violations")), check)


def count_orphans(child: DataFrame, parent: DataFrame, check: ForeignKeyCheck) -> DataFrame:
    """Child keys are counted before they meet the parent, so a frequent key is one row."""
    keys = child.filter(F.col(check.key).isNotNull()) if check.nulls_exempt else child
    orphans = (
        keys.groupBy(F.col(check.key).alias("_child"))
        .agg(F.count("*").alias("n"))
        .join(parent.select(F.col(check.parent_key).alias("_parent")), F.col("_child") == F.col("_parent"), "left_anti")
    )
    return _labelled(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), check)


def _labelled(counted: DataFrame, check: Check) -> DataFrame:
    return counted.select(F.lit(check.name).alias("check"), "violations")


def run_checks(
    tables: Mapping[str, DataFrame], checks: list[Check], known: Mapping[str, int] | None = None
) -> DataFrame:
    """(status, check, violations, description), one row per check; those in ``known`` are counted already."""
    known = known or {}
    by_table: dict[str, list[RowCheck]] = {}
    for check in checks:
        if isinstance(check, RowCheck) and check.name not in known:
            by_table.setdefault(check.table, []).append(check)
    counted = [count_row_violations(tables[table], group) for table, group in by_table.items()]
    for check in checks:
        if isinstance(check, UniqueCheck):
            counted.append(count_duplicates(tables[check.table], check))
        elif isinstance(check, ForeignKeyCheck):
            counted.append(count_orphans(tables[check.table], tables[check.parent], check))

    if known:
        spark = next(iter(tables.values())).sparkSession
        counted.append(spark.createDataFrame([(c.name, known[c.name]) for c in checks if c.name in known], "check string, violations long"))
    name, n = F.col("check"), F.col("violations")
    when_zero = F.create_map(*[F.lit(x) for c in checks for x in (c.name, c.expect_zero)])
    described = F.create_map(*[F.lit(x) for c in checks for x in (c.name, c.description)])
    passed = F.when(when_zero[name], n == 0).otherwise(n > 0)
    return reduce(DataFrame.unionByName, counted).select(
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        "check",
        "violations",
        described[name].alias("description"),
    )


def summary(report: DataFrame) -> DataFrame:
    failed = F.col("status") == "FAIL"
    return report.agg(
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count("*").alias("total"),
        (F.count_if(failed) == 0).alias("all_passed"),
    )


def all_passed(report: DataFrame) -> bool:
    return summary(report).first()["all_passed"]
