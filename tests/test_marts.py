from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.conftest import ITEM_SCHEMA
from tradewind.plans import marts as m
from tradewind.settings import Settings


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_snapshot_counts_excluded_orders(fact_orders):
    orders = fact_orders(
        ("o1", "p1", "delivered", "2018-01-01 10:00:00", 0, 1.0, None),
        ("o2", "p1", "canceled", "2018-05-05 23:00:00", None, 1.0, None),
    )
    assert m.rfm_snapshot_date(orders).first()["ref_date"] == date(2018, 5, 6)


def test_customer_history(fact_orders, customers):
    orders = fact_orders(
        ("o1", "p1", "delivered", "2017-12-31 23:00:00", -3, 100.0, "4.00"),
        ("o2", "p1", "shipped", "2018-02-01 01:00:00", None, 50.5, None),
        ("o3", "p1", "canceled", "2018-03-01 00:00:00", None, 999.0, "1.00"),
        ("o4", "p2", "unavailable", "2018-03-01 00:00:00", None, 5.0, None),
        ("o5", "lost", "delivered", "2018-03-01 00:00:00", 1, 5.0, None),
    )
    found = by(m.rfm_customer_orders(orders, customers(p1="SP", p2="RJ")), "customer_key")
    assert set(found) == {"p1"}
    p1 = found["p1"]
    assert (p1["frequency"], p1["monetary"], p1["delivered_count"], p1["recency_days"]) == (2, 150.5, 1, 29)
    assert (p1["avg_review_score"], p1["avg_delivery_delay"], p1["state"]) == (4.0, -3.0, "SP")
    clv = m.annualised_clv(m.rfm_customer_orders(orders, customers(p1="SP"))).first()["annualised_clv"]
    assert clv == 150.5 * 2 / 3 * 12  # December to February touches three months


def test_first_tile_is_the_best_unless_turned(fact_orders, customers):
    orders = fact_orders(
        *[(f"o{i}", f"p{i}", "delivered", f"2018-01-0{i} 10:00:00", 0, 100.0 * i, None) for i in range(1, 6)]
    )
    people = customers(**{f"p{i}": "SP" for i in range(1, 6)})
    found = by(m.customer_rfm(orders, people), "customer_key")
    assert {k: (r["r_score"], r["m_score"]) for k, r in found.items()} == {f"p{i}": (6 - i, 6 - i) for i in range(1, 6)}
    turned = by(m.customer_rfm(orders, people, Settings(best_is_high=True)), "customer_key")
    assert {k: (r["r_score"], r["m_score"]) for k, r in turned.items()} == {f"p{i}": (i, i) for i in range(1, 6)}


def expected_segment(r, f, monetary):
    if f <= 2:
        if r >= 4:
            return "Promising"
        if r == 3:
            return "Needs Attention"
        return "Cant Lose" if monetary >= 200 else ("Lost" if r == 1 else "Needs Attention")
    if r <= 2:
        return "At Risk"
    return "Champion" if r >= 4 and f >= 4 else "Loyal"


def test_every_segment_cell(spark):
    cells = [(r, f, 3, amount) for r, f, amount in product(range(1, 6), range(1, 6), (199.99, 200.0))]
    df = spark.createDataFrame(cells, "r_score int, f_score int, m_score int, monetary double")
    for row in m.rfm_segment(df).collect():
        assert row["segment"] == expected_segment(row["r_score"], row["f_score"], row["monetary"]), row
    scores = m.rfm_segment(spark.createDataFrame([(1, 2, 2, 0.0)], df.schema)).first()
    assert scores["rfm_score"] == 1.67


def test_monthly_sales(fact_orders, calendar):
    orders = fact_orders(
        ("o1", "p1", "delivered", "2017-01-05 10:00:00", 2, 10.0, "5.00"),
        ("o2", "p1", "shipped", "2017-01-31 23:59:59", None, 20.0, None),
        ("o3", "p2", "canceled", "2017-01-06 10:00:00", None, 90.0, "1.00"),
        ("o4", "p2", "delivered", "2016-12-31 10:00:00", 0, 1.0, None),
        ("o5", "p2", "delivered", "2018-10-31 10:00:00", -1, 7.0, None),
    )
    months = m.monthly_sales(orders, calendar).collect()
    assert [r["month_start"] for r in months] == [date(2017, 1, 1), date(2018, 10, 1)]
    january = months[0]
    assert (january["total_orders"], january["unique_customers"], january["total_revenue"]) == (2, 1, 30.0)
    assert (january["avg_order_value"], january["late_deliveries"], january["delivered_orders"]) == (15.0, 1, 1)
    assert (january["month_name"], january["avg_review_score"]) == ("January", 5.0)


def items(spark, *tuples):
    """(order, line, product, seller, price, freight, ratio, score, delay, status)"""
    return spark.createDataFrame(list(tuples), ITEM_SCHEMA)


def test_category_performance(spark):
    lines = items(
        spark,
        ("o1", 1, "a", "s1", 10.0, 1.0, 0.0909, None, 2, "delivered"),
        ("o1", 2, "a", "s2", 20.0, 1.0, None, None, None, "delivered"),
        ("o2", 1, "b", "s1", 5.0, 1.0, 0.2, None, -1, "shipped"),
        ("o3", 1, "b", "s1", 500.0, 1.0, 0.2, None, -1, "canceled"),
    )
    products = spark.createDataFrame([("a", "toys"), ("b", "books")], "product_key string, category string")
    ranked = m.category_performance(lines, products).collect()
    assert [r["category"] for r in ranked] == ["toys", "books"]
    toys = ranked[0]
    assert (toys["total_orders"], toys["units_sold"], toys["seller_count"]) == (1, 2, 2)
    assert (toys["total_revenue"], toys["avg_price"], toys["avg_freight_ratio"]) == (30.0, 15.0, 0.091)
    assert (toys["avg_review_score"], toys["avg_delivery_delay"]) == (None, 2.0)


def test_delivery_by_state_weighs_orders_by_lines(spark, fact_orders, customers):
    orders = fact_orders(
        ("o1", "p1", "delivered", "2018-01-01 00:00:00", 4, 1.0, "1.00"),
        ("o2", "p1", "delivered", "2018-01-01 00:00:00", -2, 1.0, "5.00"),
        ("o3", "p1", "delivered", "2018-01-01 00:00:00", None, 1.0, None),
        ("o4", "p1", "shipped", "2018-01-01 00:00:00", None, 1.0, None),
        ("o5", "p1", "delivered", "2018-01-01 00:00:00", 9, 1.0, None),  # has no lines
    )
    lines = items(
        spark,
        *[("o1", i, "a", "s", 1.0, 3.0, 0.5, None, 4, "delivered") for i in range(3)],
        ("o2", 1, "a", "s", 1.0, 1.0, 0.1, None, -2, "delivered"),
        ("o3", 1, "a", "s", 1.0, None, None, None, None, "delivered"),
        ("o4", 1, "a", "s", 1.0, 50.0, 0.9, None, None, "shipped"),
    )
    state = m.delivery_by_state(orders, customers(p1="SP"), lines).first()
    assert state["customer_state"] == "SP" and state["total_orders"] == 3
    assert (state["avg_delay_days"], state["late_count"], state["late_pct"]) == (2.5, 3, 60.0)
    assert (state["avg_review_score"], state["avg_freight_ratio"], state["avg_freight_value"]) == (2.0, 0.4, 2.5)


def test_delivery_buckets(spark):
    delays = [-14, -13, -7, -6, 0, 1, 7, 8]
    df = spark.createDataFrame([(d,) for d in delays], "d int").select(m.delivery_bucket(F.col("d")).alias("b"))
    names = ["Very Early (>14d)"] + ["Early (7-14d)"] * 2 + ["On Time (0-7d early)"] * 2 + ["Late (1-7d)"] * 2
    assert [r["b"] for r in df.collect()] == names + ["Very Late (>7d)"]


def test_satisfaction_rounds_half_scores_up(fact_orders):
    scores = ["1.50", "2.50", "3.50", "4.50", "4.49"]
    orders = fact_orders(
        *[(f"o{i}", "p", "delivered", "2018-01-01 00:00:00", 0, 1.0, s) for i, s in enumerate(scores)],
        ("late", "p", "delivered", "2018-01-01 00:00:00", 8, 1.0, "4.00"),
        ("open", "p", "shipped", "2018-01-01 00:00:00", 8, 1.0, "4.00"),
    )
    found = {(r["review_score"], r["delivery_bucket"]): r for r in m.satisfaction_vs_delivery(orders).collect()}
    assert {k[0] for k in found} == {2, 3, 4, 5}
    assert found[4, "On Time (0-7d early)"]["order_count"] == 2
    assert found[4, "On Time (0-7d early)"]["pct_of_score"] == 66.7
    assert found[4, "Very Late (>7d)"]["pct_of_score"] == 33.3


def test_data_quality(spark, fact_orders):
    orders = fact_orders(
        ("o1", "p", "delivered", "2018-01-01 00:00:00", None, 0.0, None),
        ("o2", "p", "canceled", "2018-01-01 00:00:00", None, 5.0, "4.00"),
    )
    lines = items(spark, ("o1", 1, "a", "s", 0.0, 1.0, 1.0, None, None, "delivered"))
    found = by(m.data_quality(orders, lines), "table_name")
    assert list(found["fact_orders"])[1:] == [2, 1, 1, 1, 2, 1, 1]
    assert list(found["fact_order_items"])[1:] == [1, 0, 1, 0, 0, 0, 1]


def test_outlier_marts_flag_both_sides(fact_orders):
    usual = [(f"u{i}", "p", "delivered", "2018-01-01 00:00:00", i % 5, 100.0 + i % 7, "3.00") for i in range(60)]
    orders = fact_orders(
        *usual,
        ("rich", "p", "delivered", "2018-01-01 00:00:00", 90, 9000.0, "1.00"),
        ("poor", "p", "delivered", "2018-01-01 00:00:00", -90, 0.5, "5.00"),
        ("free", "p", "delivered", "2018-01-01 00:00:00", 0, 0.0, None),
        ("lost", "p", "canceled", "2018-01-01 00:00:00", None, 99999.0, None),
    )
    paid = by(m.payment_outliers(orders), "order_id")
    assert {k: r["outlier_flag"] for k, r in paid.items()} == {"rich": "high_outlier", "poor": "low_outlier"}
    assert paid["rich"]["total_orders"] == 62
    late = by(m.delivery_outliers(orders), "order_id")
    assert {k: r["outlier_flag"] for k, r in late.items()} == {"rich": "extreme_late", "poor": "extreme_early"}


def test_risk_register(spark):
    rfm = spark.createDataFrame(
        [("At Risk", 10.0), ("Cant Lose", 5.4), ("Loyal", 100.0), ("Lost", 1.0)], "segment string, monetary double"
    )
    states = spark.createDataFrame(
        [("SP", 4, 1.0), ("RJ", 2, 2.0), ("AM", 1, 6.1)], "customer_state string, late_count bigint, late_pct double"
    )
    outliers = spark.createDataFrame(
        [("high_outlier", 900.6), ("low_outlier", 0.5)], "outlier_flag string, total_payment double"
    )
    risks = by(m.risk_register(rfm, states, outliers), "risk_category")
    figures = {k: (r["affected_count"], r["affected_pct"], r["revenue_at_risk"]) for k, r in risks.items()}
    assert figures == {
        "Customer Churn": (2, 50.0, 15.0),
        "Delivery Failure": (7, 3.0, None),
        "Geographic Concentration": (2, 66.7, None),
        "Payment Anomaly": (2, None, 901.0),
    }


def test_empty_input_gives_empty_marts_and_null_percentages(spark, fact_orders, customers, calendar):
    nothing = fact_orders(("o", "p", "delivered", "2018-01-01 00:00:00", 0, 1.0, None)).filter("false")
    no_items, nobody = items(spark, ("o", 1, "a", "s", 1.0, 1.0, 0.5, None, 0, "x")).filter("false"), customers(p="SP").filter("false")
    products = spark.createDataFrame([], "product_key string, category string")
    wh = {
        "fact_orders": nothing, "fact_order_items": no_items, "dim_customers": nobody,
        "dim_date": calendar, "dim_products": products,
    }
    built = m.build_marts(wh)
    for name in ("customer_rfm", "monthly_sales", "category_performance", "delivery_by_state",
                 "satisfaction_vs_delivery", "payment_outliers", "delivery_outliers"):
        assert built[name].count() == 0, name
    assert [r["total_rows"] for r in built["data_quality"].collect()] == [0, 0]
    risks = by(built["risk_register"], "risk_category")
    assert len(risks) == 4
    assert all(r["affected_pct"] is None for r in risks.values())


@pytest.mark.parametrize("limit", [1997, 2018])
def test_sales_years_are_a_parameter(fact_orders, calendar, limit):
    orders = fact_orders(("o1", "p1", "delivered", "2018-01-05 10:00:00", 2, 10.0, None))
    found = m.monthly_sales(orders, calendar, Settings(first_sales_year=1990, last_sales_year=limit))
    assert found.count() == (limit == 2018)
