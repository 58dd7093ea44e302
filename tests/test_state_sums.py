"""Delivery figures by state keep no sums for each order."""

import re
from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tradewind.plans.marts import delivery_by_state


def test_no_task_keeps_sums_for_each_order(spark):
    frame = entry.queries()["delivery_by_state"](spark, "/root/testdata/sf0.001")
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    by_order = [line for line in re.findall(r"Aggregate \[[^\n]*", text) if "order_id" in line.split("]")[0]]
    assert not any("sum(" in line for line in by_order)


def test_repeated_orders_unknown_states_and_orders_without_lines(spark):
    orders = spark.createDataFrame(
        [(1, "a", "delivered", 2, 4.5), (1, "a", "delivered", 2, 4.5), (2, "b", "delivered", -3, None),
         (3, "b", "delivered", 1, 1.0), (4, "a", "canceled", 9, 1.0), (None, "a", "delivered", 7, 1.0)],
        "order_id long, customer_key string, order_status string, delivery_delay_days int, avg_review_score double",
    ).withColumn("purchased_at", F.lit(datetime(2018, 1, 1)))
    orders = orders.withColumn("avg_review_score", F.col("avg_review_score").cast("decimal(3,2)"))
    people = spark.createDataFrame([("a", None), ("b", "SP")], "customer_key string, state string")
    items = spark.createDataFrame(
        [(1, 10.0, 0.1), (1, 20.0, None), (2, 1e-25, 0.25), (4, 5.0, 0.5), (None, 5.0, 0.5)],
        "order_id long, freight_value double, freight_ratio double",
    )
    rows = {r["customer_state"]: r.asDict() for r in delivery_by_state(orders, people, items).collect()}
    assert set(rows) == {None, "SP"}
    assert rows[None] == {
        "customer_state": None, "total_orders": 1, "avg_delay_days": 2.0, "late_count": 4, "late_pct": 100.0,
        "avg_review_score": 4.5, "avg_freight_ratio": 0.1, "avg_freight_value": 15.0,
    }
    assert rows["SP"]["total_orders"] == 1 and rows["SP"]["late_count"] == 0 and rows["SP"]["avg_review_score"] is None
