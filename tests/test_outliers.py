import math
import statistics

import pytest

from tradewind.operators.outliers import iqr_outliers


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")


def test_only_rows_strictly_outside_the_fences(spark):
    # Quartiles 3 and 7, fences -3 and 13.
    values = [-3.0, 1.0, 3.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.0, 9.0, 13.0]
    assert iqr_outliers(frame(spark, values), "x", "high", "low").count() == 0
    spread = values + [-40.0, 40.0]
    found = {r["x"]: r for r in iqr_outliers(frame(spark, spread), "x", "high", "low").collect()}
    assert set(found) == {-40.0, 40.0}
    assert found[40.0]["outlier_flag"] == "high" and found[-40.0]["outlier_flag"] == "low"
    bounds = found[40.0]
    assert (bounds["q1"], bounds["q3"], bounds["iqr"]) == (3.0, 7.0, 4.0)
    assert (bounds["lower_fence"], bounds["upper_fence"], bounds["n"]) == (-3.0, 13.0, 13)


def test_on_the_fence_is_inside(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]  # quartiles 3 and 7
    assert iqr_outliers(frame(spark, values * 100 + [13.0, -3.0]), "x", "high", "low").count() == 0
    assert iqr_outliers(frame(spark, values * 100 + [13.01, -3.01]), "x", "high", "low").count() == 2


def test_no_spread_gives_no_z_score(spark):
    assert iqr_outliers(frame(spark, [5.0] * 6), "x", "high", "low").count() == 0
    assert iqr_outliers(frame(spark, [5.0]), "x", "high", "low").count() == 0


def test_no_rows(spark):
    found = iqr_outliers(frame(spark, []), "x", "high", "low")
    assert found.count() == 0 and "z_score" in found.columns


def test_fences_reach_the_scan(spark, tmp_path):
    frame(spark, [float(i) for i in range(50)] + [1e6]).write.parquet(str(tmp_path / "t"))
    found = iqr_outliers(spark.read.parquet(str(tmp_path / "t")), "x", "high", "low")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x" in plan and "LessThan(x" in plan
    assert [r["x"] for r in found.collect()] == [1e6]


def test_small_scales_keep_their_digits(spark):
    values = [i * 1e-6 for i in range(1, 12)] + [1e-3]
    (found,) = iqr_outliers(frame(spark, values), "x", "high", "low").collect()
    mean = math.fsum(values) / 12
    assert found["mean"] == pytest.approx(mean, rel=1e-12)
    assert found["std"] == pytest.approx(statistics.stdev(values), rel=1e-9)


def test_the_deviation_does_not_depend_on_the_order_of_rows(spark):
    values = [math.sin(i) * 1e3 for i in range(500)] + [1e5]
    one, other = (
        iqr_outliers(frame(spark, v).repartition(n), "x", "high", "low").first() for v, n in ((values, 1), (values[::-1], 7))
    )
    assert one["std"] == other["std"] and one["mean"] == other["mean"]


def test_values_that_are_no_numbers_do_not_break_it(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0]
    assert iqr_outliers(frame(spark, values + [math.nan] * 3), "x", "high", "low").count() >= 0
    found = iqr_outliers(frame(spark, values + [math.inf]), "x", "high", "low").collect()
    assert [r["x"] for r in found] == [math.inf]


@pytest.mark.parametrize("scale", [1e-300, 1e-30, 1e-18, 1.0, 1e30, 1e300])
def test_moments_at_any_scale(spark, scale):
    values = [float(x) * scale / 100 for x in range(1, 100)] + [5.0 * scale]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    (row,) = iqr_outliers(df, "x", "high", "low").collect()
    shares = [v / scale for v in values]
    assert row["mean"] / scale == pytest.approx(statistics.fmean(shares), rel=1e-13)
    assert row["std"] / scale == pytest.approx(statistics.stdev(shares), rel=1e-12) and row["outlier_flag"] == "high"
