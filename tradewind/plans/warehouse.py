"""Star schema: four dimensions and two facts from the staged tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.functions.dates import date_key, lenient_timestamp, weekday_from_sunday
from tradewind.functions.numeric import (
    exact_avg,
    exact_sum,
    round_half_away,
    safe_ratio,
)
from tradewind.lazy import Frames
from tradewind.operators.scratch import materialize
from tradewind.settings import Settings

# One row per day: three centuries are still far below any broadcast limit.
MAX_BROADCAST_DAYS = 110_000


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Calendar over [start, end)."""
    last = end - timedelta(days=1)
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(last), F.expr("interval 1 day"))).alias("date")
    )
    weekday = weekday_from_sunday(F.col("date"))
    calendar = days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        weekday.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
    return F.broadcast(calendar) if (end - start).days <= MAX_BROADCAST_DAYS else calendar


def geo_zip_centroid(geolocation: DataFrame) -> DataFrame:
    """Mean position of every zip prefix."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code")).agg(
        exact_avg(F.col("geolocation_lat")).alias("lat"),
        exact_avg(F.col("geolocation_lng")).alias("lng"),
    )


def dim_customers(customers: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row per person: the record with the highest customer id.

    ``max`` of a struct combines before the shuffle, so a person with very many
    records never gathers in one task. Its first field decides, the rest only
    breaks ties between records with the same id.
    """
    latest = F.max(
        F.struct("customer_id", "customer_zip_code_prefix", "customer_city", "customer_state")
    ).alias("latest")
    people = (
        customers.groupBy("customer_unique_id")
        .agg(latest)
        .select(
            F.col("customer_unique_id").alias("customer_key"),
            F.col("latest.customer_id"),
            F.col("latest.customer_zip_code_prefix").alias("zip_code"),
            F.col("latest.customer_city").alias("city"),
            F.col("latest.customer_state").alias("state"),
        )
    )
    return people.join(centroids, "zip_code", "left").select(
        "customer_key", "customer_id", "zip_code", "city", "state", "lat", "lng"
    )


def dim_sellers(sellers: DataFrame, centroids: DataFrame) -> DataFrame:
    return (
        sellers.select(
            F.col("seller_id").alias("seller_key"),
            F.col("seller_zip_code_prefix").alias("zip_code"),
            F.col("seller_city").alias("city"),
            F.col("seller_state").alias("state"),
        )
        .join(centroids, "zip_code", "left")
        .select("seller_key", "zip_code", "city", "state", "lat", "lng")
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category in English, else as given, else 'unknown'."""
    size = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    return products.join(translation, "product_category_name", "left").select(
        F.col("product_id").alias("product_key"),
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown")).alias(
            "category"
        ),
        F.col("product_category_name").alias("category_pt"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        F.col("product_weight_g").alias("weight_g"),
        size[0].alias("length_cm"),
        size[1].alias("height_cm"),
        size[2].alias("width_cm"),
        (size[0].cast("bigint") * size[1] * size[2]).alias("volume_cm3"),
    )


def payment_agg(payments: DataFrame) -> DataFrame:
    """Payments of an order; the distinct payment types in alphabetical order."""
    return payments.groupBy("order_id").agg(
        exact_sum(F.col("payment_value")).alias("total_payment"),
        F.max("payment_installments").alias("max_installments"),
        F.when(
            F.count("payment_type") > 0, F.array_join(F.sort_array(F.collect_set("payment_type")), ",")
        ).alias("payment_types"),
    )


def review_agg(reviews: DataFrame) -> DataFrame:
    """Mean score, two decimals, and whether any review carries text."""
    message = F.col("review_comment_message")
    mean = safe_ratio(F.sum(F.col("review_score").cast("bigint")), F.count("review_score"))
    return reviews.groupBy("order_id").agg(
        round_half_away(mean, 2).cast("decimal(3,2)").alias("avg_review_score"),
        F.bool_or(message.isNotNull() & (message != "")).alias("has_review_comment"),
    )


def fact_orders(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order of a known customer.

    Customers are joined first, while rows are narrow; the joins on ``order_id`` follow, so
    the result stays partitioned by order for the item fact and the per-order counts.
    """
    purchased = lenient_timestamp(F.col("order_purchase_timestamp"))
    delivered = lenient_timestamp(F.col("order_delivered_customer_date"))
    estimated = lenient_timestamp(F.col("order_estimated_delivery_date"))
    people = customers.select("customer_id", F.col("customer_unique_id").alias("customer_key"))
    return (
        orders.join(people, "customer_id")
        .select(
            "order_id",
            "customer_key",
            date_key(purchased).alias("purchase_date_key"),
            "order_status",
            purchased.alias("purchased_at"),
            lenient_timestamp(F.col("order_approved_at")).alias("approved_at"),
            lenient_timestamp(F.col("order_delivered_carrier_date")).alias("shipped_at"),
            delivered.alias("delivered_at"),
            estimated.alias("estimated_delivery_at"),
            F.datediff(delivered, estimated).alias("delivery_delay_days"),
        )
        .join(payment_agg(payments), "order_id", "left")
        .join(review_agg(reviews), "order_id", "left")
        .select(
            "order_id",
            "customer_key",
            "purchase_date_key",
            "order_status",
            "purchased_at",
            "approved_at",
            "shipped_at",
            "delivered_at",
            "estimated_delivery_at",
            "delivery_delay_days",
            F.coalesce("total_payment", F.lit(0.0)).alias("total_payment"),
            "max_installments",
            "payment_types",
            "avg_review_score",
            F.coalesce("has_review_comment", F.lit(False)).alias("has_review_comment"),
        )
    )


# What the item fact takes over from its order.
ORDER_ATTRIBUTES = [
    "order_id",
    "customer_key",
    "purchase_date_key",
    "purchased_at",
    "avg_review_score",
    "delivery_delay_days",
    "order_status",
]


PURCHASE_MONTH = "purchase_month"


def with_purchase_month(fact: DataFrame) -> DataFrame:
    """A fact with the month of purchase as yyyymm, by which it can be stored."""
    return fact.withColumn(PURCHASE_MONTH, F.floor(F.col("purchase_date_key") / 100).cast("int"))


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line, with the attributes of its order."""
    gross = F.col("price") + F.col("freight_value")
    return items.join(
        orders.select(*ORDER_ATTRIBUTES),
        "order_id",
    ).select(
        "order_id",
        "order_item_id",
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        "customer_key",
        "purchase_date_key",
        "purchased_at",
        "price",
        "freight_value",
        gross.alias("total_item_value"),
        round_half_away(safe_ratio(F.col("freight_value"), gross), 4).alias("freight_ratio"),
        "avg_review_score",
        "delivery_delay_days",
        "order_status",
    )


def build_warehouse(
    staged: Mapping[str, DataFrame],
    spark: SparkSession,
    settings: Settings = Settings(),
    centroids: DataFrame | None = None,
) -> Frames:
    """The six warehouse tables. Pass stored centroids to have them computed once for both dimensions.

    The item fact joins a stored copy of the order columns it needs: both sides of that join
    are then plain shuffles, which adaptive execution can split where one order holds very
    many lines.
    """

    def centroid() -> DataFrame:
        return geo_zip_centroid(staged["geolocation"]) if centroids is None else centroids

    def orders() -> DataFrame:
        return fact_orders(
            staged["orders"], staged["customers"], staged["order_payments"], staged["order_reviews"]
        )

    built = Frames(
        {
            "dim_date": lambda: dim_date(spark, settings.calendar_start, settings.calendar_end),
            "dim_customers": lambda: dim_customers(staged["customers"], centroid()),
            "dim_sellers": lambda: dim_sellers(staged["sellers"], centroid()),
            "dim_products": lambda: dim_products(staged["products"], staged["category_translation"]),
            "fact_orders": orders,
            "fact_order_items": lambda: fact_order_items(
                staged["order_items"], materialize(built["fact_orders"].select(*ORDER_ATTRIBUTES), "order_attributes")
            ),
        }
    )
    return built
