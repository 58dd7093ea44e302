"""The seventeen checks every built warehouse has to pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tradewind.operators.quality import Check, ForeignKeyCheck, RowCheck, UniqueCheck, not_null, run_checks


def _outside(column: str, low: float, high: float):
    return lambda: (F.col(column) < low) | (F.col(column) > high)


def _negative(column: str):
    return lambda: F.col(column) < 0


# Check names and descriptions.
WAREHOUSE_CHECKS: list[Check] = [
    not_null("no_null_order_id", "fact_orders", "order_id", "fact_orders.order_id must never be null"),
    not_null("no_null_customer_key", "fact_orders", "customer_key", "Every order must link to a customer"),
    not_null("no_null_product_key", "fact_order_items", "product_key", "Every item must link to a product"),
    not_null(
        "no_null_purchase_date", "fact_orders", "purchased_at", "All orders must have a purchase timestamp"
    ),
    UniqueCheck(
        "no_duplicate_orders",
        "fact_orders",
        "Each order_id must appear exactly once in fact_orders",
        key="order_id",
    ),
    UniqueCheck(
        "no_duplicate_customers",
        "dim_customers",
        "Each customer_unique_id must appear once in dim_customers",
        key="customer_key",
    ),
    UniqueCheck(
        "no_duplicate_products",
        "dim_products",
        "Each product_id must appear once in dim_products",
        key="product_key",
    ),
    ForeignKeyCheck(
        "items_orders_fk",
        "fact_order_items",
        "All order items must reference a valid order",
        key="order_id",
        parent="fact_orders",
        parent_key="order_id",
    ),
    ForeignKeyCheck(
        "items_product_fk",
        "fact_order_items",
        "All order items must reference a valid product",
        key="product_key",
        parent="dim_products",
        parent_key="product_key",
    ),
    ForeignKeyCheck(
        "items_seller_fk",
        "fact_order_items",
        "All order items must reference a valid seller",
        key="seller_key",
        parent="dim_sellers",
        parent_key="seller_key",
    ),
    ForeignKeyCheck(
        "orders_date_fk",
        "fact_orders",
        "All purchase dates must exist in dim_date",
        key="purchase_date_key",
        parent="dim_date",
        parent_key="date_key",
        nulls_exempt=True,
    ),
    RowCheck(
        "no_negative_price",
        "fact_order_items",
        "Item prices must be non-negative",
        violation=_negative("price"),
    ),
    RowCheck(
        "no_negative_freight",
        "fact_order_items",
        "Freight values must be non-negative",
        violation=_negative("freight_value"),
    ),
    RowCheck(
        "no_negative_payment",
        "fact_orders",
        "Order payments must be non-negative",
        violation=_negative("total_payment"),
    ),
    RowCheck(
        "review_score_range",
        "fact_orders",
        "Review scores must be between 1 and 5",
        violation=_outside("avg_review_score", 1, 5),
    ),
    RowCheck(
        "freight_ratio_range",
        "fact_order_items",
        "Freight ratio must be between 0 and 1",
        violation=_outside("freight_ratio", 0, 1),
    ),
    RowCheck(
        "delivery_before_purchase",
        "fact_orders",
        "Delivery date cannot be before purchase date",
        violation=lambda: F.col("delivered_at") < F.col("purchased_at"),
    ),
]


def quality_report(
    wh: Mapping[str, DataFrame], checks: list[Check] = WAREHOUSE_CHECKS, known: Mapping[str, int] | None = None
) -> DataFrame:
    return run_checks(wh, checks, known)
