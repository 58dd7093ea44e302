"""Marketplace tables derived from a retail schema (orders, lineitem, part, ...).

The mapping is plain arithmetic on the columns of the retail tables, so that any
engine derives the same rows from them. It keeps repeat and one-time customers,
moving customers, missing reviews, late and undelivered orders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.lazy import Frames
from tradewind.settings import Settings

RETAIL_SETTINGS = Settings(
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2001, 1, 1),
    first_sales_year=1997,
    last_sales_year=1998,
    home_state="NATION_0",
    valuable_from=200000.0,
    histogram_cap=400000.0,
    underserved_min_customers=400,
)


# The columns the mapping reads; declared, so that planning opens no data file.
RETAIL_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_extendedprice double, l_tax double""",
    "events": "event_id bigint, props string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
}


def marketplace_tables(spark: SparkSession, folder: str) -> Frames:
    """The nine raw marketplace tables over ``folder/<retail table>.parquet``."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(RETAIL_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return Frames(
        {
            "orders": lambda: _orders(table("orders")),
            "order_items": lambda: _order_items(table("lineitem")),
            "payments": lambda: _payments(table("lineitem")),
            "reviews": lambda: _reviews(table("events")),
            "customers": lambda: _customers(table("orders"), table("customer"), table("nation")),
            "sellers": lambda: _sellers(table("supplier")),
            "products": lambda: _products(table("part")),
            "geolocation": lambda: _geolocation(table("customer")),
            "category_translation": lambda: _translation(table("part")),
        }
    )


def _orders(orders: DataFrame) -> DataFrame:
    days = "o_orderdate + make_dt_interval(cast({0} as int))".format
    return orders.withColumn(
        "order_status",
        F.expr(
            """case o_orderkey % 50 when 0 then 'canceled' when 1 then 'unavailable'
               when 2 then 'shipped' when 3 then 'processing' else 'delivered' end"""
        ),
    ).selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as customer_id",
        "order_status",
        """o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400)
           as order_purchase_timestamp""",
        f"{days(1)} as order_approved_at",
        f"{days(2)} as order_delivered_carrier_date",
        f"""case when order_status = 'delivered' and o_orderkey % 97 <> 0
            then {days("4 + o_orderkey * 7919 % 31 + if(o_orderkey % 211 = 0, 60, 0)")} end
            as order_delivered_customer_date""",
        f"{days('20 + o_orderkey % 10')} as order_estimated_delivery_date",
    )


def _customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    return (
        orders.join(customer, F.expr("c_custkey = o_custkey"))
        .join(nation, F.expr("n_nationkey = c_nationkey"))
        .selectExpr(
            "o_orderkey as customer_id",
            "if(o_orderkey % 3 = 0, o_custkey, 1000000 + o_orderkey) as customer_unique_id",
            "cast(o_custkey % 510 as int) as customer_zip_code_prefix",
            "'CITY_' || (o_orderkey % 40) as customer_city",
            "n_name as customer_state",
        )
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "l_extendedprice as price",
        "l_extendedprice * l_tax * l_linenumber as freight_value",
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey as order_id",
        """case l_linenumber % 4 when 0 then 'voucher' when 1 then 'credit_card'
           when 2 then 'boleto' else 'debit_card' end as payment_type""",
        "l_linenumber * 3 % 10 + 1 as payment_installments",
        "l_extendedprice as payment_value",
    )


def _reviews(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id div 2 as order_id",
        "cast(1 + (event_id * 31 div 7) % 5 as int) as review_score",
        "case event_id % 5 when 0 then null when 1 then '' else props end as review_comment_message",
    )


def _sellers(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "s_suppkey as seller_id",
        "cast(s_suppkey % 510 as int) as seller_zip_code_prefix",
        "'CITY_' || (s_suppkey % 40) as seller_city",
        "'NATION_' || if(s_nationkey < 20, s_nationkey, s_nationkey - 20) as seller_state",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.withColumn("step", F.expr("cast(p_partkey % 7 as int)")).selectExpr(
        "p_partkey as product_id",
        "if(p_partkey % 13 = 0, null, p_type) as product_category_name",
        "length(p_name) as product_name_lenght",
        "p_size * 10 + step as product_description_lenght",
        "step as product_photos_qty",
        "p_size * 100 + step as product_weight_g",
        "p_size as product_length_cm",
        "p_size + step as product_height_cm",
        "step + 1 as product_width_cm",
    )


def _geolocation(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "cast(c_custkey % 500 as int) as geolocation_zip_code_prefix",
        """cast('-' || (29 - c_nationkey) || '.' || lpad(cast(c_custkey * 123456789 % 1000000000000 as string), 12, '0')
           as double) as geolocation_lat""",
        "-70D + c_nationkey as geolocation_lng",
    )


def _translation(part: DataFrame) -> DataFrame:
    return (
        part.select("p_type")
        .distinct()
        .selectExpr(
            "p_type as product_category_name",
            "if(p_type <> 'PROMO', lower(p_type) || '_goods', null) as product_category_name_english",
        )
    )
