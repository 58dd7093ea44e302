"""Full-refresh tables in catalog databases, replaced in one step."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

ROWS = "rows"
_OBSERVED: dict[tuple[str, str], dict[str, int]] = {}
KEPT_VERSIONS = 2  # the current files of a table and those before them


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def write_table(
    df: DataFrame,
    database: str,
    name: str,
    *,
    partition_by: tuple[str, ...] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
    observed: dict[str, Column] | None = None,
) -> DataFrame:
    """Replace ``database.name`` with the rows of ``df`` and return the stored table.

    The rows are written beside the table, under a path of their own; only when all are there does the table point to
    them. So a job that fails changes nothing, a table may be rebuilt from itself, and who has begun to read
    goes on with the files of before, which stay until the refresh after next. A table of the same columns and
    buckets is repointed in one catalog call; where these change, or with partitions, it is renamed into place.

    Tables bucketed on the same key and count join and aggregate on it without a shuffle; a
    shuffle before the write makes each bucket one file.

    ``observed`` names aggregates of the rows, worked out by the tasks that write them; ``observations`` gives them back.
    """
    spark = df.sparkSession
    if bucket_by and buckets:
        df = df.repartition(buckets, bucket_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)  # a partition's rows in few files, a large one's in several
    watch = Observation() if observed else None
    if observed:
        df = df.observe(watch, F.count(F.lit(1)).alias(ROWS), *[value.alias(f"m_{key}") for key, value in observed.items()])
    version = uuid.uuid4().hex
    folder = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/versions.{name}"
    staged = f"{name}__{version}"
    writer = df.write.format("parquet").option("path", f"{folder}/{version}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.saveAsTable(f"`{database}`.`{staged}`")
        _swap(spark, database, name, staged, f"{folder}/{version}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{staged}`")
        _delete(spark, f"{folder}/{version}")
        raise
    _forget_old(spark, folder, version)
    stored = spark.table(f"`{database}`.`{name}`")
    if watch:
        _OBSERVED[(database, name)] = {key.removeprefix("m_"): value for key, value in watch.get.items()}
    return stored


def observations(database: str, name: str, stored: DataFrame) -> dict[str, int]:
    """What the last write of a table in this session observed, and its rows as ``ROWS``.

    Nothing where the number of rows differs from what the files' footers say, as after a write by someone else.
    """
    found = _OBSERVED.get((database, name), {})
    return found if found and found[ROWS] == stored.count() else {}


def _swap(spark: SparkSession, database: str, name: str, staged: str, path: str) -> None:
    """``name`` now shows what ``staged`` shows."""
    table, fresh = f"`{database}`.`{name}`", f"`{database}`.`{staged}`"
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    elif _layout(spark, table) == _layout(spark, fresh) and not _layout(spark, table)[2]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.sql(f"DROP TABLE {fresh}")
    else:
        old = f"`{database}`.`{name}__old_{uuid.uuid4().hex}`"
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)


def _layout(spark: SparkSession, table: str) -> tuple:
    """Kind of table, columns and buckets, partition columns."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    buckets = [facts.get(k) for k in ("Type", "Num Buckets", "Bucket Columns", "Sort Columns")]
    return spark.table(table).schema.simpleString(), buckets, partitions


def _forget_old(spark: SparkSession, folder: str, current: str) -> None:
    """Deletes all but the latest versions of a table's files."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    others = [s for s in files.listStatus(root) if s.getPath().getName() != current]
    for old in sorted(others, key=lambda s: -s.getModificationTime())[KEPT_VERSIONS - 1 :]:
        files.delete(old.getPath(), True)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table, as one query; of stored tables it reads the files' footers only."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
