import datetime
import decimal
import random

import duckdb
import pytest
from pyspark.sql import Window, functions as F

from tradewind.operators import order_statistics as selection
from tradewind.operators.order_statistics import exact_quantiles, ntile_starts, order_statistics, with_ntiles


@pytest.fixture(params=["few rows fetched", "all rows fetched"])
def fetched(request, monkeypatch):
    """Small limits, so that few rows go through all the rounds that very many would."""
    if request.param == "few rows fetched":
        for name, value in (("GRID", 8), ("ACCURACY", 20), ("FETCHED", 3)):
            monkeypatch.setattr(selection, name, value)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 13, 100, 1001])
@pytest.mark.parametrize("tiles", [1, 4, 5])
def test_ntile_starts_agree_with_sql(n, tiles):
    tile = [r[0] for r in duckdb.execute(f"select ntile({tiles}) over (order by i) from range({n}) t(i) order by i").fetchall()]
    assert ntile_starts(n, tiles) == [i for i in range(1, n) if tile[i] != tile[i - 1]]


def ntiles_by_window(df, order, tiles):
    return {r["key"]: r["t"] for r in df.select("key", F.ntile(tiles).over(Window.orderBy(*order)).alias("t")).collect()}


@pytest.mark.parametrize("n", [1, 7, 503])
@pytest.mark.parametrize("kind", ["spread", "ties", "one hot value"])
def test_distributed_ntile_equals_the_window(spark, fetched, n, kind):
    rng = random.Random(n)
    value = {
        "spread": lambda i: rng.uniform(-1000, 1000),
        "ties": lambda i: float(rng.randrange(3)),
        "one hot value": lambda i: 1.0 if i % 3 else rng.uniform(0, 5),
    }[kind]
    df = spark.createDataFrame([(f"k{rng.random():.12f}", value(i)) for i in range(n)], "key string, x double")
    df = df.repartition(5)
    scores = {"up": F.col("x"), "down": -F.col("x")}
    found = with_ntiles(df, scores, tie="key", tiles=5).collect()
    assert {r["key"]: r["up"] for r in found} == ntiles_by_window(df, [F.asc("x"), F.asc("key")], 5)
    assert {r["key"]: r["down"] for r in found} == ntiles_by_window(df, [F.desc("x"), F.asc("key")], 5)


def test_missing_scores_come_last(spark, fetched):
    df = spark.createDataFrame([(i, None if i < 4 else float(i)) for i in range(10)], "key bigint, x double")
    found = with_ntiles(df, {"t": F.col("x")}, tie="key", tiles=5).collect()
    assert {r["key"]: r["t"] for r in found} == {4: 1, 5: 1, 6: 2, 7: 2, 8: 3, 9: 3, 0: 4, 1: 4, 2: 5, 3: 5}


def test_no_rows(spark):
    df = spark.createDataFrame([], "key bigint, x double")
    assert with_ntiles(df, {"t": F.col("x")}, tie="key", tiles=5).count() == 0
    assert exact_quantiles(df, "x", [0.25, 0.75]) == [None, None]


def test_tiles_differ_by_at_most_one(spark, fetched):
    df = spark.range(1234).select(F.col("id").alias("key"), (F.col("id") % 7).cast("double").alias("x"))
    sizes = [r["n"] for r in with_ntiles(df, {"t": F.col("x")}, "key", 5).groupBy("t").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1234 and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n", [1, 3, 10, 777])
def test_quantiles_equal_sql(spark, fetched, n):
    rng = random.Random(n)
    values = [round(rng.uniform(1, 500), 2) if rng.random() < 0.6 else 99.99 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    expected = duckdb.execute(
        "select quantile_cont(v, 0.25), quantile_cont(v, 0.75) from (select unnest(?::double[]) v)", [values]
    ).fetchone()
    assert tuple(exact_quantiles(df, "x", [0.25, 0.75])) == expected


def test_big_integers_keep_their_order(spark, fetched):
    big = 2**53
    df = spark.createDataFrame([(0, big + 1), (1, big), (2, big + 3), (3, None)], "id int, x bigint")
    tiles = {r["id"]: r["tile"] for r in with_ntiles(df, {"tile": F.col("x")}, "id", 4).collect()}
    assert tiles == {1: 1, 0: 2, 2: 3, 3: 4}


def test_quantiles_with_values_that_are_no_numbers(spark, fetched):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (-inf, 1.0, 2.0, inf)], "x double")
    assert exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [-inf, 1.5, inf]
    (low, high) = exact_quantiles(spark.createDataFrame([(1.0,), (float("nan"),)], "x double"), "x", [0.0, 1.0])
    assert low == 1.0 and high != high


INF, NAN = float("inf"), float("nan")
COLUMNS = {
    "long": ("bigint", [2**60 + i % 7 for i in range(90)] + [-(2**62), 2**63 - 1] * 9 + [None] * 8),
    "decimal(38,9)": ("decimal(38,9)", [decimal.Decimal(10**28 + i % 5) + decimal.Decimal(i % 3).scaleb(-9) for i in range(90)] + [None] * 8),
    "double": ("double", [1.0] * 40 + [NAN] * 20 + [INF] * 20 + [-INF] * 20 + [None] * 20 + [0.0, -0.0, 1e-300, -1e300]),
    "string": ("string", [f"customer_{i % 40:08d}" for i in range(80)] + ["a", "a\0", "", "é", "b" * 30, "b" * 29 + "c", None, "\U0001f600"] * 4),
    "date": ("date", [datetime.date(2000, 1, 1) + datetime.timedelta(days=i % 30) for i in range(90)] + [None] * 9),
    "one value": ("int", [5] * 100),
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_every_rank_of_every_type_equals_a_sort(spark, fetched, name):
    kind, values = COLUMNS[name]
    rows = [(v, f"t{i:03d}") for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, f"x {kind}, tie string").repartition(3)
    wanted = [(r["x"], r["tie"]) for r in df.orderBy("x", "tie").collect()]
    ranks = [0, 1, len(rows) // 2, len(rows) * 3 // 4, len(rows) - 1]
    found = order_statistics(df, {"up": [F.col("x"), F.col("tie")]}, lambda n: ranks)
    size, at = found["up"]
    assert size == len(rows) and {k: repr(tuple(v)) for k, v in at.items()} == {k: repr(wanted[k]) for k in ranks}


def test_several_orders_share_their_reads(spark, monkeypatch):
    """Two orders of a few thousand rows: a sketch, a count and the rows, without any shuffle of rows."""
    monkeypatch.setattr(selection, "FETCHED", 500)
    df = spark.range(30_000).select(F.col("id").alias("key"), (F.col("id") * 7919 % 10_007).cast("double").alias("x"))
    reads = []
    original = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: reads.append(1) or original(self, *a))
    found = order_statistics(df, {"up": [F.col("x")], "down": [-F.col("x")]}, lambda n: [n // 4, n // 2])
    assert len(reads) == 2
    ordered = sorted(i * 7919 % 10_007 for i in range(30_000))
    assert [found["up"][1][p]["v0"] for p in (7_500, 15_000)] == [ordered[7_500], ordered[15_000]]
    assert [-found["down"][1][p]["v0"] for p in (7_500, 15_000)] == [ordered[-7_501], ordered[-15_001]]
