"""Intermediate tables on shared storage.

A frame that several jobs read is written once as parquet and read back. Unlike a
cache it survives the loss of executors, unlike a checkpoint it stays columnar, so
later jobs prune columns and push filters into it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: ContextVar[list[str] | None] = ContextVar("scratch_paths", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir, else one beside the warehouse's tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the scratch root; the enclosing ``scratch_scope`` removes what is put there."""
    path = f"{scratch_root(spark).rstrip('/')}/tradewind/{label}-{uuid.uuid4().hex}"
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the scratch tables written inside: frames that read them are void then."""
    token = _WRITTEN.set([])
    try:
        yield
    finally:
        written = _WRITTEN.get()
        _WRITTEN.reset(token)
        for path in written:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
