"""Several distinct counts beside sums, without copying every row for each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_distinct_counts(summed: DataFrame, rows: DataFrame, keys: list[str], **counted: str) -> DataFrame:
    """``summed``, one row per keys, with the number of distinct values of columns of ``rows``.

    Two ``countDistinct`` in one aggregate expand every row to three. Here each count is a pass of its own over
    two columns, which combines before it shuffles; pass stored rows. Keys must not be null.
    """
    for name, column in counted.items():
        distinct = rows.select(*keys, column).distinct().groupBy(*keys).agg(F.count(column).alias(name))
        summed = summed.join(distinct, keys)
    return summed
