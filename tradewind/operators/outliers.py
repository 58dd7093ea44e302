"""Outliers beyond the interquartile fences."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.numeric import exact_avg, exact_sum, round_half_away, safe_ratio
from tradewind.operators.order_statistics import exact_quantiles

EXACT_AS_IS = (1e-3, 1e15)  # largest values of columns that are added as they are


def iqr_outliers(
    df: DataFrame, column: str, high_label: str, low_label: str, k: float = 1.5
) -> DataFrame:
    """Rows strictly outside Q1 - k*IQR .. Q3 + k*IQR, with the bounds and a z-score.

    Adds q1, q3, iqr, lower_fence, upper_fence, mean, std, n (unrounded, the same on every
    row), outlier_flag and z_score (2 decimals). The fences are constants by the time
    the rows are read, so the filter reaches the scan. ``df`` is read for the quartiles
    (``exact_quantiles``), the mean, the deviation and the rows: pass a table or a materialized frame.
    """
    least, q1, q3, most = exact_quantiles(df, column, [0.0, 0.25, 0.75, 1.0])
    number = F.col(column).cast("double")
    n, mean = _mean(df, number, least, most)
    std = _deviation(df, number, n, mean, least, most)

    iqr = None if q1 is None else q3 - q1
    low = None if iqr is None else q1 - k * iqr
    high = None if iqr is None else q3 + k * iqr

    def constant(value: float | None):
        return F.lit(value).cast("double")

    value = F.col(column)
    return df.filter((value > constant(high)) | (value < constant(low))).select(
        *df.columns,
        constant(q1).alias("q1"),
        constant(q3).alias("q3"),
        constant(iqr).alias("iqr"),
        constant(low).alias("lower_fence"),
        constant(high).alias("upper_fence"),
        constant(mean).alias("mean"),
        constant(std).alias("std"),
        F.lit(n).cast("bigint").alias("n"),
        F.when(value > constant(high), high_label).otherwise(low_label).alias("outlier_flag"),
        round_half_away(
            safe_ratio(value.cast("double") - constant(mean), constant(std)), 2
        ).alias("z_score"),
    )


def _unit(size: float) -> float:
    """About ``size``, as a power of two: numbers in this unit keep their digits, whatever the column's scale."""
    return 2.0 ** (math.frexp(size)[1] if size and math.isfinite(size) else 0)


def _mean(df: DataFrame, number: Column, least: float | None, most: float | None) -> tuple[int, float | None]:
    """Count and mean; values are added in units of about the largest, so that neither scale nor order matters."""
    largest = 0.0 if least is None else max(abs(least), abs(most))
    unit = 1.0 if EXACT_AS_IS[0] <= largest < EXACT_AS_IS[1] else _unit(largest)
    row = df.agg(exact_avg(number / F.lit(unit)).alias("mean"), F.count(number).alias("n")).first()
    return row["n"], None if row["mean"] is None else row["mean"] * unit


def _deviation(df: DataFrame, number: Column, n: int, mean: float | None, least: float | None, most: float | None) -> float | None:
    """Sample standard deviation from exactly added squares of deviations, in units of about the largest."""
    if n < 2:
        return None
    spread = max(most - mean, mean - least)
    if spread == 0 or not math.isfinite(spread):
        return 0.0 if spread == 0 else math.nan
    unit = _unit(spread)
    off = (number - F.lit(mean)) / F.lit(unit)
    total = df.agg(exact_sum(off * off).alias("total")).first()["total"]
    return unit * math.sqrt(total / (n - 1))
