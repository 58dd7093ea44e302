"""Rounding, order-independent sums and safe ratios.

Sums of doubles depend on the order in which partitions are merged, so the same
job can differ in the last bit from run to run. Sums and means here add decimals
instead and turn the total into a double once, at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# What sums add: 18 decimals of a double's shortest text, up to 20 digits before the point.
EXACT = "decimal(38,18)"
LOW_UNITS, LEAST = 1e20, 1e-21
WHOLE = (0.1, 1e20)  # sizes between which 18 decimals hold all of a double's text
FEW = 1e6  # so do they for numbers of at most six decimals


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Scale, round half away from zero, scale back.

    ``F.round(x, 2)`` rounds the decimal text of a double (1.005 -> 1.01). Scaling
    first rounds the stored value (1.005 -> 1.0), as the SQL this library follows.
    """
    factor = float(10**digits)
    return F.round(value.cast("double") * factor, 0) / factor


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Round the scaled value half to even, as data frames in Python do."""
    factor = float(10**digits)
    return F.rint(value.cast("double") * factor) / factor


def exact_sum(value: Column) -> Column:
    """Sum of doubles that no order of adding changes.

    Each value is a decimal of 18 places and what these leave over, another decimal 20 places further down; both are
    added exactly, 38 places in all beside values of up to 1e20. Where all values are too small for that, one is
    larger, NaN or infinite, or a total is too large, the plain sum of doubles takes over, in either ANSI
    mode: then the order can show in the last digit, but nothing is cut or left out.
    """
    number = value.cast("double")
    high = number.try_cast(EXACT)
    size = F.abs(number)
    # Of most numbers nothing is left over; for them the second decimal is neither made nor added.
    whole = ((size >= WHOLE[0]) | (F.rint(size * FEW) / FEW == size)) & (size < WHOLE[1])
    rest = number - high.cast("double")  # exact: the two are next to each other
    low = F.when(~whole, (rest * F.lit(LOW_UNITS)).try_cast(EXACT))
    fine = (F.count_if((size > 0) & (size < LEAST)) == 0) | (F.max(size) >= 1000 * LEAST)
    within = (F.count(high) == F.count(number)) & fine
    rests = F.when(F.count(low) == 0, F.lit(0.0)).otherwise(F.try_sum(low).cast("double") / F.lit(LOW_UNITS))
    total = F.try_sum(high).cast("double") + rests
    return F.coalesce(F.when(within, total), F.sum(number))


def exact_avg(value: Column) -> Column:
    """Mean of the non-null values; NULL when there are none."""
    return safe_ratio(exact_sum(value), F.count(value))


def exact_avg_of_scores(value: Column) -> Column:
    """Mean of two-decimal scores, kept as decimals of one long."""
    return safe_ratio(F.sum(value.cast("decimal(3,2)")), F.count(value))


def exact_avg_of_ints(value: Column) -> Column:
    return safe_ratio(F.sum(value.cast("bigint")), F.count(value))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division in doubles; a zero denominator gives NULL under ANSI mode too."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return safe_ratio(F.lit(100.0) * part, whole)


def count_when(condition: Column) -> Column:
    return F.count_if(condition)


def banded(value: Column, limits: list[float], *, descending: bool = False) -> Column:
    """1-based band of a value: the first limit it falls below, or reaches when descending."""
    steps = [(value >= limit) if descending else (value < limit) for limit in limits]
    return first_match([(step, F.lit(i)) for i, step in enumerate(steps, 1)], F.lit(len(limits) + 1))


def first_match(branches: list[tuple[Column, Column]], default: Column) -> Column:
    """CASE with the branches tried in the given order."""
    (condition, result), *rest = branches
    chain = reduce(lambda acc, branch: acc.when(*branch), rest, F.when(condition, result))
    return chain.otherwise(default)
