"""Exact sums with and without remainders."""

from fractions import Fraction

from pyspark.sql import functions as F

from tradewind.functions.numeric import exact_sum


def test_the_second_decimal_is_made_for_remainders_only(spark):
    def summed(values):
        return spark.createDataFrame([(v,) for v in values], "v double").select(exact_sum(F.col("v"))).first()[0]

    mixed = [0.1, 123456.789, 1 / 3, 2 / 3e4, 1e-7, 0.000123, -7.0, 0.0, 3.3e-12, 99999.99, None] * 3
    exact = lambda values: float(sum(Fraction(repr(v)) for v in values if v is not None))
    assert summed(mixed) == exact(mixed)
    assert summed([0.25, 4.0, 1e9 + 0.01]) == exact([0.25, 4.0, 1e9 + 0.01])
    assert summed([1e-19, 2e-19]) == exact([1e-19, 2e-19])
    assert summed([None]) is None
    assert summed([1.0, float("inf")]) == float("inf")
