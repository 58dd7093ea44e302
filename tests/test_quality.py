from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.operators.quality import RowCheck, all_passed, run_checks, summary
from tradewind.plans.checks import WAREHOUSE_CHECKS, quality_report
from tradewind.plans.warehouse import dim_date

JAN = datetime(2018, 1, 2, 3, 4, 5)
ORDERS = """order_id string, customer_key string, purchase_date_key int, purchased_at timestamp_ntz,
    delivered_at timestamp_ntz, total_payment double, avg_review_score decimal(3,2)"""
ITEMS = "order_id string, product_key string, seller_key string, price double, freight_value double, freight_ratio double"

CLEAN = {
    "fact_orders": [("o1", "p1", 20180102, JAN, JAN, 0.0, Decimal("1.00")), ("o2", "p1", 20180102, JAN, None, 5.0, None)],
    "fact_order_items": [("o1", "x", "s", 0.0, 0.0, None), ("o1", "x", "s", 5.0, 5.0, 0.5)],
    "dim_customers": [("p1",)],
    "dim_products": [("x",)],
    "dim_sellers": [("s",)],
}
SCHEMAS = {
    "fact_orders": ORDERS,
    "fact_order_items": ITEMS,
    "dim_customers": "customer_key string",
    "dim_products": "product_key string",
    "dim_sellers": "seller_key string",
}

# Check -> table and the one row that breaks it, and any other check the row breaks too.
DEFECTS = {
    "no_null_order_id": ("fact_orders", (None, "p1", 20180102, JAN, JAN, 1.0, None), set()),
    "no_null_customer_key": ("fact_orders", ("o3", None, 20180102, JAN, JAN, 1.0, None), set()),
    "no_null_product_key": ("fact_order_items", ("o1", None, "s", 1.0, 1.0, 0.5), {"items_product_fk"}),
    "no_null_purchase_date": ("fact_orders", ("o3", "p1", None, None, JAN, 1.0, None), set()),
    "no_duplicate_orders": ("fact_orders", ("o1", "p1", 20180102, JAN, JAN, 1.0, None), set()),
    "no_duplicate_customers": ("dim_customers", ("p1",), set()),
    "no_duplicate_products": ("dim_products", ("x",), set()),
    "items_orders_fk": ("fact_order_items", ("gone", "x", "s", 1.0, 1.0, 0.5), set()),
    "items_product_fk": ("fact_order_items", ("o1", "gone", "s", 1.0, 1.0, 0.5), set()),
    "items_seller_fk": ("fact_order_items", ("o1", "x", None, 1.0, 1.0, 0.5), set()),
    "orders_date_fk": ("fact_orders", ("o3", "p1", 20190101, JAN, JAN, 1.0, None), set()),
    "no_negative_price": ("fact_order_items", ("o1", "x", "s", -0.01, 1.0, 0.5), set()),
    "no_negative_freight": ("fact_order_items", ("o1", "x", "s", 1.0, -0.01, 0.5), set()),
    "no_negative_payment": ("fact_orders", ("o3", "p1", 20180102, JAN, JAN, -1.0, None), set()),
    "review_score_range": ("fact_orders", ("o3", "p1", 20180102, JAN, JAN, 1.0, Decimal("5.01")), set()),
    "freight_ratio_range": ("fact_order_items", ("o1", "x", "s", 1.0, 1.0, 1.01), set()),
    "delivery_before_purchase": ("fact_orders", ("o3", "p1", 20180102, JAN, datetime(2018, 1, 2, 3, 4, 4), 1.0, None), set()),
}


def warehouse(spark, table=None, row=None):
    data = CLEAN if table is None else CLEAN | {table: [*CLEAN[table], row]}
    frames = {name: spark.createDataFrame(data[name], SCHEMAS[name]) for name in SCHEMAS}
    return frames | {"dim_date": dim_date(spark, date(2018, 1, 1), date(2019, 1, 1))}


def test_seventeen_checks_have_a_defect():
    assert [c.name for c in WAREHOUSE_CHECKS] == list(DEFECTS) and len(DEFECTS) == 17


def test_clean_tables_pass(spark):
    report = quality_report(warehouse(spark))
    assert {(r["status"], r["violations"]) for r in report.collect()} == {("PASS", 0)}
    assert summary(report).first().asDict() == {"passed": 17, "failed": 0, "total": 17, "all_passed": True}
    assert all_passed(report)


@pytest.mark.parametrize("name", list(DEFECTS))
def test_one_defect_is_one_violation(spark, name):
    table, row, others = DEFECTS[name]
    expected = {name, *others}
    wh = warehouse(spark, table, row)
    related = [c for c in WAREHOUSE_CHECKS if c.table == table or c.name in expected]
    report = run_checks(wh, related).filter(F.col("violations") > 0).collect()
    assert {(r["check"], r["violations"], r["status"]) for r in report} == {(n, 1, "FAIL") for n in expected}


def test_frequent_orphans_are_all_counted(spark):
    wh = warehouse(spark)
    lines = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "gone").when(F.col("id") % 3 == 1, None).otherwise("x").alias("product_key")
    )
    check = [c for c in WAREHOUSE_CHECKS if c.name == "items_product_fk"]
    assert run_checks(wh | {"fact_order_items": lines}, check).first()["violations"] == 1667 + 1667


def test_a_check_may_expect_violations(spark):
    check = RowCheck("has_paid_orders", "fact_orders", expect_zero=False, violation=lambda: F.col("total_payment") > 0)
    assert run_checks(warehouse(spark), [check]).first()["status"] == "PASS"
    nobody_paid = warehouse(spark) | {"fact_orders": warehouse(spark)["fact_orders"].filter("total_payment = 0")}
    assert run_checks(nobody_paid, [check]).first()["status"] == "FAIL"


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    warehouse(spark)["fact_orders"].write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    row_checks = [c for c in WAREHOUSE_CHECKS if isinstance(c, RowCheck) and c.table == "fact_orders"]
    plan = run_checks({"fact_orders": stored}, row_checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
