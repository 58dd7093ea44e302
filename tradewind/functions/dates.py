"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(value: Column) -> Column:
    """Integer yyyymmdd, from calendar parts rather than through a formatted string."""
    return F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)


def weekday_from_sunday(value: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(value) - 1


def month_boundaries(start: Column, end: Column) -> Column:
    """Month ends crossed between two dates: 31 January to 1 February is one."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def month_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def lenient_timestamp(value: Column) -> Column:
    """Timestamp without zone; text that is no timestamp, '' included, becomes NULL."""
    return value.try_cast("timestamp_ntz")
