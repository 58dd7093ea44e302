import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewind.functions import dates, labels, numeric


def value_of(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.675, 2, 2.68), (-2.5, 0, -3.0), (2.5, 0, 3.0), (0.5, 0, 1.0), (None, 1, None)],
)
def test_round_half_away_rounds_the_scaled_value(spark, value, digits, expected):
    assert value_of(spark, numeric.round_half_away(F.lit(value).cast("double"), digits)) == expected


@pytest.mark.parametrize("value, expected", [(0.25, 0.2), (0.35, 0.4), (0.45, 0.4), (1.0, 1.0)])
def test_round_half_even(spark, value, expected):
    assert value_of(spark, numeric.round_half_even(F.lit(value), 1)) == expected


def test_ratio_by_zero_and_percent_of_nothing_are_null(spark):
    assert value_of(spark, numeric.safe_ratio(F.lit(1.0), F.lit(0))) is None
    assert value_of(spark, numeric.percent(F.lit(3), F.lit(0))) is None
    assert value_of(spark, numeric.percent(F.lit(1), F.lit(3))) == 100.0 / 3


def test_exact_sum_does_not_depend_on_order_or_partitions(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, 12345.67, 0.01] * 500
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    total = numeric.exact_sum(F.col("x"))
    expected = 500 * 1000012346.28
    for shuffled in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("x"))):
        assert shuffled.agg(total.alias("t")).first()["t"] == expected


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(numeric.exact_avg(F.col("x"))).first()[0] is None
    assert df.filter("false").agg(numeric.exact_avg(F.col("x"))).first()[0] is None


@pytest.mark.parametrize(
    "start, end, months",
    [("2018-01-31", "2018-02-01", 1), ("2018-02-01", "2018-02-01", 0), ("2017-12-31", "2018-01-01", 1), ("2016-01-15", "2018-03-01", 26)],
)
def test_month_boundaries(spark, start, end, months):
    start, end = (F.lit(date.fromisoformat(d)) for d in (start, end))
    assert value_of(spark, dates.month_boundaries(start, end)) == months


def test_calendar_parts(spark):
    sunday = F.lit(date(2018, 11, 4))
    assert value_of(spark, dates.weekday_from_sunday(sunday)) == 0
    assert value_of(spark, dates.date_key(sunday)) == 20181104
    assert value_of(spark, dates.month_label(F.lit(2018), F.lit(3))) == "2018-03"


def test_empty_text_is_no_timestamp(spark):
    assert value_of(spark, dates.lenient_timestamp(F.lit(""))) is None
    assert value_of(spark, dates.lenient_timestamp(F.lit("2018-01-02 03:04:05"))).hour == 3


def test_bands(spark):
    rising = [value_of(spark, numeric.banded(F.lit(v), [4, 8, 12, 16])) for v in (3.9, 4.0, 15.9, 16.0)]
    falling = [
        value_of(spark, numeric.banded(F.lit(v), [4.3, 4.0, 3.7, 3.4], descending=True)) for v in (4.3, 4.29, 3.4, 3.39)
    ]
    assert rising == [1, 2, 4, 5]
    assert falling == [1, 2, 4, 5]


def test_title_case_follows_anything_but_a_letter(spark):
    assert value_of(spark, labels.title_label(F.lit("home-appliances_2nd o'neil ÉTÉ"))) == "Home-Appliances 2Nd O'Neil Été"


def sum_of(spark, values, function=numeric.exact_sum):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(function(F.col("x"))).first()[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_lose_nothing(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert sum_of(spark, [0.00004, 0.00004]) == 0.00008
        assert sum_of(spark, [1e-6, 1.1e-5, 1e-3]) == 0.001012
        assert sum_of(spark, [2e14, 1.0]) == 2e14 + 1
        assert sum_of(spark, [1e15, 0.25, None]) == 1e15 + 0.25
        assert sum_of(spark, [1e25, 1.0]) == 1e25
        assert sum_of(spark, [9e19] * 4) == 3.6e20
        assert sum_of(spark, [1.0, float("inf")]) == float("inf")
        assert str(sum_of(spark, [1.0, float("nan")])) == "nan"
        assert sum_of(spark, [None, None]) is None
        assert sum_of(spark, [-23.123456789012, -23.123456789012], numeric.exact_avg) == -23.123456789012
        assert sum_of(spark, [1e-6, 2e-6, 3e-6], numeric.exact_avg) == 2e-6
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_labels_and_levels(spark):
    assert value_of(spark, labels.title_label(F.lit("bed_bath_table"))) == "Bed Bath Table"
    assert [value_of(spark, labels.level_score(F.lit(v))) for v in ("High", "Medium", "Low", "other")] == [3, 2, 1, 1]
    assert [value_of(spark, labels.risk_level(F.lit(v))) for v in (9, 6, 4, 3, 2)] == ["High", "High", "Medium", "Medium", "Low"]
    assert labels.state_lookup(spark).count() == 27


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_lose_no_digit_at_any_scale(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert sum_of(spark, [3e-19, 4e-19]) == pytest.approx(7e-19, rel=1e-15)
        assert sum_of(spark, [1.23456789012e-15] * 3) == pytest.approx(3.70370367036e-15, rel=1e-15)
        assert sum_of(spark, [1.23456789012e-15] * 3, numeric.exact_avg) == pytest.approx(1.23456789012e-15, rel=1e-15)
        for scale in (1e-300, 1e-100, 1e-40, 1e-21, 1e-18, 1e-6, 1.0, 1e17, 1e25, 1e300):
            assert sum_of(spark, [1.2345678901234567 * scale, 2.5 * scale]) == pytest.approx(3.7345678901234567 * scale, rel=1e-15, abs=0)
        assert sum_of(spark, [1e15, 1e-20, -1e15]) == 1e-20  # where plain doubles give nothing
        assert sum_of(spark, [1e300, 1e-300, None]) == 1e300
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_small_sums_do_not_depend_on_the_order(spark):
    draw = random.Random(2)
    values = [draw.uniform(-1, 1) * 10.0 ** draw.randint(-20, 3) for _ in range(500)]
    totals = set()
    for parts in (1, 2, 7):
        draw.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        totals.add(df.agg(numeric.exact_sum(F.col("x"))).first()[0])
    assert len(totals) == 1 and totals.pop() == pytest.approx(math.fsum(values), rel=1e-14)
