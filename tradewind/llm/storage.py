"""Files and tables of intermediate results in the folder all executors share."""

from __future__ import annotations

from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.scratch import scratch_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder as a full URI, so that executors need no Hadoop settings to read it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path on it."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(uri)


def stored(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, with the stronger compression that bulky columns are worth."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
