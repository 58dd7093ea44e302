"""The nine marts, as functions of warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.dates import month_boundaries, month_start
from tradewind.functions.numeric import (
    count_when,
    exact_avg,
    exact_avg_of_ints,
    exact_avg_of_scores,
    exact_sum,
    first_match,
    percent,
    round_half_away,
    safe_ratio,
)
from tradewind.lazy import Frames
from tradewind.operators.order_statistics import with_ntiles
from tradewind.operators.outliers import iqr_outliers
from tradewind.operators.distinct import with_distinct_counts
from tradewind.operators.scratch import materialize
from tradewind.plans.warehouse import PURCHASE_MONTH
from tradewind.settings import Settings

CHURN_SEGMENTS = ("At Risk", "Cant Lose")

# Delivery buckets, earliest first, and the largest delay of each.
DELIVERY_BUCKETS = [
    ("Very Early (>14d)", -14),
    ("Early (7-14d)", -7),
    ("On Time (0-7d early)", 0),
    ("Late (1-7d)", 7),
    ("Very Late (>7d)", None),
]

# Category, description, likelihood, impact and mitigation of each risk.
RISKS = {
    "churn": (
        "Customer Churn",
        "High proportion of one-time buyers (97%) with valuable at-risk segments",
        "High",
        "High",
        "Loyalty programme, personalised re-engagement, subscription bundles",
    ),
    "delivery": (
        "Delivery Failure",
        "Late deliveries correlated with 1-star reviews; concentrated in non-SP states",
        "Medium",
        "High",
        "Realistic ETA communication, regional carrier diversification",
    ),
    "geo": (
        "Geographic Concentration",
        "Seller base heavily concentrated in Sao Paulo; underserved states face high freight",
        "Medium",
        "Medium",
        "Recruit sellers in AM, RR, AP, PA to reduce freight disparity",
    ),
    "payment": (
        "Payment Anomaly",
        "Extreme payment values detected via IQR — potential fraud or data error",
        "Low",
        "Medium",
        "Payment value caps, automated fraud rules, manual review queue",
    ),
}


def _excluded(settings: Settings) -> Column:
    return F.col("order_status").isin(*settings.excluded_statuses)


def _delivered(settings: Settings) -> Column:
    return F.col("order_status") == settings.delivered_status


def _late() -> Column:
    return F.col("delivery_delay_days") > 0


# ---------------------------------------------------------------- customer segments


def rfm_snapshot_date(orders: DataFrame) -> DataFrame:
    """The day after the last purchase, whatever became of that order."""
    return orders.agg(F.date_add(F.max("purchased_at").cast("date"), 1).alias("ref_date"))


def rfm_customer_orders(
    orders: DataFrame, customers: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Purchase history per customer, over orders that were not excluded.

    One pass over the fact: excluded orders stay in until the last purchase of all is
    known. Counting orders through a first grouping by order needs no shuffle where the
    fact is still partitioned by order, and a customer with very many orders meets the
    dimension as a single row. The result reads a stored table.
    """
    kept = ~_excluded(settings)

    def of_kept(column: str) -> Column:
        return F.when(kept, F.col(column))

    per_order = orders.groupBy("customer_key", "order_id").agg(
        F.max("purchased_at").alias("latest"),
        F.bool_or(kept).alias("kept"),
        exact_sum(of_kept("total_payment")).alias("paid"),
        F.max(of_kept("purchased_at")).alias("last"),
        F.min(of_kept("purchased_at")).alias("first"),
        F.sum(of_kept("avg_review_score").cast("decimal(3,2)")).alias("score"),
        F.count(of_kept("avg_review_score")).alias("score_n"),
        F.sum(of_kept("delivery_delay_days")).alias("delay"),
        F.count(of_kept("delivery_delay_days")).alias("delay_n"),
        count_when(kept & _delivered(settings)).alias("delivered"),
    )
    per_customer = per_order.groupBy("customer_key").agg(
        F.max("latest").alias("latest"),
        count_when(F.col("kept")).alias("frequency"),
        exact_sum(F.col("paid")).alias("monetary"),
        F.max("last").cast("date").alias("last_order_date"),
        F.min("first").cast("date").alias("first_order_date"),
        safe_ratio(F.sum("score"), F.sum("score_n")).alias("avg_review_score"),
        safe_ratio(F.sum("delay"), F.sum("delay_n")).alias("avg_delivery_delay"),
        F.sum("delivered").alias("delivered_count"),
    )
    places = customers.select("customer_key", "city", "state", "lat", "lng", F.lit(True).alias("known"))
    stored = materialize(per_customer.join(places, "customer_key", "left"), "customer_orders")
    snapshot = stored.agg(F.date_add(F.max("latest").cast("date"), 1)).scalar()
    return stored.filter(F.col("known") & (F.col("frequency") > 0)).select(
        "customer_key",
        "city",
        "state",
        "lat",
        "lng",
        "frequency",
        "monetary",
        "last_order_date",
        "first_order_date",
        F.datediff(snapshot, "last_order_date").alias("recency_days"),
        "avg_review_score",
        "avg_delivery_delay",
        "delivered_count",
    )


def rfm_scores(history: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Recency, frequency and monetary tiles 1..k, ties settled by customer key.

    As in the source, tile 1 holds the most recent, most frequent, highest spending
    customers; ``best_is_high`` turns the scale round. ``history`` is read twice and should
    come from storage, as ``rfm_customer_orders`` returns it.
    """
    ascending = {
        "r_score": F.col("recency_days").cast("double"),
        "f_score": -F.col("frequency").cast("double"),
        "m_score": -F.col("monetary"),
    }
    if settings.best_is_high:
        ascending = {name: -score for name, score in ascending.items()}
    return with_ntiles(history, ascending, tie="customer_key", tiles=settings.tiles)


def rfm_segment(scored: DataFrame, settings: Settings = Settings()) -> DataFrame:
    r, f = F.col("r_score"), F.col("f_score")
    segment = first_match(
        [
            ((r >= 4) & (f >= 4), F.lit("Champion")),
            ((r >= 3) & (f >= 3), F.lit("Loyal")),
            ((r >= 4) & (f <= 2), F.lit("Promising")),
            ((r <= 2) & (f >= 3), F.lit("At Risk")),
            ((r <= 2) & (f <= 2) & (F.col("monetary") >= settings.valuable_from), F.lit("Cant Lose")),
            (r <= 1, F.lit("Lost")),
        ],
        F.lit("Needs Attention"),
    )
    total = r + f + F.col("m_score")
    return scored.withColumns(
        {"rfm_score": round_half_away(safe_ratio(total, F.lit(3.0)), 2), "segment": segment}
    )


def annualised_clv(history: DataFrame) -> DataFrame:
    months = month_boundaries(F.col("first_order_date"), F.col("last_order_date")) + 1
    yearly = safe_ratio(F.col("monetary") * F.col("frequency"), months) * 12
    return history.withColumn("annualised_clv", round_half_away(yearly, 2))


def customer_rfm(
    orders: DataFrame, customers: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    history = rfm_customer_orders(orders, customers, settings)
    return annualised_clv(rfm_segment(rfm_scores(history, settings), settings))


# ---------------------------------------------------------------- sales and delivery


# What the sums and distinct counts below read of the facts.
MONTHLY_COLUMNS = [
    "order_id",
    "customer_key",
    "order_status",
    "total_payment",
    "avg_review_score",
    "delivery_delay_days",
]
CATEGORY_COLUMNS = [
    "order_id",
    "order_item_id",
    "seller_key",
    "price",
    "freight_ratio",
    "avg_review_score",
    "delivery_delay_days",
]


def orders_of_sales_years(orders: DataFrame, calendar: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Orders that count as sold in the years of the settings, with their month."""
    first, last = settings.first_sales_year, settings.last_sales_year
    key = F.col("purchase_date_key")
    # Implied by the calendar join, stated on the fact so that it can reach its scan.
    in_years = (key >= first * 10000 + 101) & (key <= last * 10000 + 1231)
    if PURCHASE_MONTH in orders.columns:  # stored by month: only these months' files are read
        in_years &= F.col(PURCHASE_MONTH).between(first * 100 + 1, last * 100 + 12)
    days = calendar.filter(F.col("year").between(first, last)).select(
        "date_key", "year", "month", "month_name"
    )
    return (
        orders.filter(~_excluded(settings) & in_years)
        .join(days, key == F.col("date_key"))
        .withColumn("month_start", month_start(F.col("purchased_at")))
        .select("year", "month", "month_name", "month_start", *MONTHLY_COLUMNS)
    )


def monthly_sales(
    orders: DataFrame, calendar: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    sold = materialize(orders_of_sales_years(orders, calendar, settings), "sold_orders")
    keys = ["year", "month", "month_name", "month_start"]
    summed = sold.groupBy(*keys).agg(
        round_half_away(exact_sum(F.col("total_payment")), 2).alias("total_revenue"),
        round_half_away(exact_avg(F.col("total_payment")), 2).alias("avg_order_value"),
        round_half_away(exact_avg_of_scores(F.col("avg_review_score")), 2).alias(
            "avg_review_score"
        ),
        count_when(_late()).alias("late_deliveries"),
        count_when(_delivered(settings)).alias("delivered_orders"),
    )
    return (
        with_distinct_counts(summed, sold, keys, total_orders="order_id", unique_customers="customer_key")
        .select(*keys, "total_orders", "unique_customers", *summed.columns[len(keys):])
        .orderBy("month_start")
    )


def category_performance(
    items: DataFrame, products: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    sold = (
        items.filter(~_excluded(settings))
        .join(products.select("product_key", "category"), "product_key")
        .select("category", *CATEGORY_COLUMNS)
    )
    sold = materialize(sold, "sold_items")
    summed = sold.groupBy("category").agg(
        F.count("order_item_id").alias("units_sold"),
        round_half_away(exact_sum(F.col("price")), 2).alias("total_revenue"),
        round_half_away(exact_avg(F.col("price")), 2).alias("avg_price"),
        round_half_away(exact_avg(F.col("freight_ratio")), 3).alias("avg_freight_ratio"),
        round_half_away(exact_avg_of_scores(F.col("avg_review_score")), 2).alias(
            "avg_review_score"
        ),
        round_half_away(exact_avg_of_ints(F.col("delivery_delay_days")), 2).alias(
            "avg_delivery_delay"
        ),
    )
    return (
        with_distinct_counts(summed, sold, ["category"], total_orders="order_id", seller_count="seller_key")
        .select("category", "total_orders", *summed.columns[1:], "seller_count")
        .orderBy(F.desc("total_revenue"), "category")
    )


def delivery_by_state(
    orders: DataFrame, customers: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Delivery figures per customer state; all but the order count weigh each order by its lines.

    Lines meet their order as they are and are summed by state at once, so that no task keeps sums for each
    of its orders. Orders with lines are counted apart, by their keys alone.
    """
    delay, score = F.col("delivery_delay_days"), F.col("avg_review_score")
    places = customers.select("customer_key", F.col("state").alias("customer_state"))
    placed = orders.filter(_delivered(settings)).join(places, "customer_key")
    placed = materialize(
        placed.select("order_id", "customer_state", "delivery_delay_days", "avg_review_score"), "placed_orders"
    )
    late = count_when(_late())
    summed = (
        items.select("order_id", "freight_value", "freight_ratio")
        .join(placed, "order_id")
        .groupBy("customer_state")
        .agg(
            round_half_away(exact_avg_of_ints(delay), 2).alias("avg_delay_days"),
            late.alias("late_count"),
            round_half_away(percent(late, F.count("*")), 1).alias("late_pct"),
            round_half_away(safe_ratio(F.sum(score.cast("decimal(5,2)")), F.count(score)), 2).alias("avg_review_score"),
            round_half_away(exact_avg(F.col("freight_ratio")), 3).alias("avg_freight_ratio"),
            round_half_away(exact_avg(F.col("freight_value")), 2).alias("avg_freight_value"),
        )
    )
    counted = (
        placed.select("order_id", "customer_state")
        .join(items.select("order_id"), "order_id", "left_semi")
        .groupBy(F.col("customer_state").alias("counted_state"))
        .agg(F.countDistinct("order_id").alias("total_orders"))
    )
    return (
        summed.join(counted, F.col("customer_state").eqNullSafe(F.col("counted_state")))
        .select("customer_state", "total_orders", *summed.columns[1:])
        .orderBy(F.desc("total_orders"), "customer_state")
    )


def delivery_bucket(delay: Column) -> Column:
    return first_match(
        [(delay <= limit, F.lit(name)) for name, limit in DELIVERY_BUCKETS if limit is not None],
        F.lit(DELIVERY_BUCKETS[-1][0]),
    )


def satisfaction_vs_delivery(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    score, delay = F.col("avg_review_score"), F.col("delivery_delay_days")
    counts = (
        orders.filter(_delivered(settings) & score.isNotNull() & delay.isNotNull())
        .groupBy(
            F.round(score.cast("decimal(3,2)"), 0).cast("int").alias("review_score"),
            delivery_bucket(delay).alias("delivery_bucket"),
        )
        .agg(F.count("*").alias("order_count"))
    )
    of_score = F.sum("order_count").over(Window.partitionBy("review_score"))
    return counts.withColumn(
        "pct_of_score", round_half_away(percent(F.col("order_count"), of_score), 1)
    ).orderBy("review_score", "delivery_bucket")


def data_quality(
    orders: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """One profile row per fact table."""
    nothing = F.lit(0).cast("bigint")

    def profile(df: DataFrame, table: str, amount: str, **order_only: Column) -> DataFrame:
        return df.agg(
            F.count("*").alias("total_rows"),
            count_when(_excluded(settings)).alias("excluded_status"),
            count_when(F.col(amount) == 0).alias("zero_payment"),
            *[
                order_only.get(name, nothing).alias(name)
                for name in ("missing_review", "missing_delay", "missing_delivery_ts")
            ],
            count_when(_delivered(settings)).alias("clean_delivered"),
        ).select(F.lit(table).alias("table_name"), "*")

    return profile(
        orders,
        "fact_orders",
        "total_payment",
        missing_review=count_when(F.col("avg_review_score").isNull()),
        missing_delay=count_when(F.col("delivery_delay_days").isNull()),
        missing_delivery_ts=count_when(F.col("delivered_at").isNull() & _delivered(settings)),
    ).unionByName(profile(items, "fact_order_items", "price"))


# ---------------------------------------------------------------- outliers and risks


def payment_outliers(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    paid = orders.filter(_delivered(settings) & (F.col("total_payment") > 0)).select(
        "order_id", "total_payment", "customer_key", "purchased_at"
    )
    found = iqr_outliers(paid, "total_payment", "high_outlier", "low_outlier", settings.fence)
    return found.select(
        *paid.columns,
        *[round_half_away(F.col(c), 2).alias(c) for c in ("q1", "q3", "iqr", "lower_fence", "upper_fence")],
        round_half_away(F.col("mean"), 2).alias("mean_payment"),
        round_half_away(F.col("std"), 2).alias("std_payment"),
        F.col("n").alias("total_orders"),
        "outlier_flag",
        "z_score",
    )


def delivery_outliers(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    arrived = orders.filter(_delivered(settings) & F.col("delivery_delay_days").isNotNull()).select(
        "order_id", "delivery_delay_days", "customer_key", "purchased_at", "avg_review_score"
    )
    found = iqr_outliers(
        arrived, "delivery_delay_days", "extreme_late", "extreme_early", settings.fence
    )
    return found.select(
        *arrived.columns,
        *[round_half_away(F.col(c), 2).alias(c) for c in ("lower_fence", "upper_fence")],
        "outlier_flag",
        "z_score",
    )


def _risk(df: DataFrame, name: str, count: Column, share: Column, revenue: Column) -> DataFrame:
    category, description, likelihood, impact, mitigation = RISKS[name]
    return df.agg(
        count.cast("bigint").alias("affected_count"),
        share.cast("double").alias("affected_pct"),
        revenue.cast("double").alias("revenue_at_risk"),
    ).select(
        F.lit(category).alias("risk_category"),
        F.lit(description).alias("description"),
        "affected_count",
        "affected_pct",
        "revenue_at_risk",
        F.lit(likelihood).alias("likelihood"),
        F.lit(impact).alias("impact"),
        F.lit(mitigation).alias("mitigation"),
    )


def risk_churn(rfm: DataFrame) -> DataFrame:
    leaving = F.col("segment").isin(*CHURN_SEGMENTS)
    spend = exact_sum(F.when(leaving, F.col("monetary")).otherwise(0.0))
    return _risk(
        rfm,
        "churn",
        count_when(leaving),
        round_half_away(percent(count_when(leaving), F.count("*")), 1),
        round_half_away(spend, 0),
    )


def risk_delivery(by_state: DataFrame) -> DataFrame:
    return _risk(
        by_state,
        "delivery",
        F.sum("late_count"),
        round_half_away(exact_avg(F.col("late_pct")), 1),
        F.lit(None),
    )


def risk_geo(by_state: DataFrame, settings: Settings = Settings()) -> DataFrame:
    elsewhere = count_when(F.col("customer_state") != settings.home_state)
    return _risk(
        by_state,
        "geo",
        elsewhere,
        round_half_away(percent(elsewhere, F.count("*")), 1),
        F.lit(None),
    )


def risk_payment(outliers: DataFrame) -> DataFrame:
    high = F.when(F.col("outlier_flag") == "high_outlier", F.col("total_payment")).otherwise(0.0)
    return _risk(
        outliers, "payment", F.count("*"), F.lit(None), round_half_away(exact_sum(high), 0)
    )


def risk_register(
    rfm: DataFrame, by_state: DataFrame, outliers: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [risk_churn(rfm), risk_delivery(by_state), risk_geo(by_state, settings), risk_payment(outliers)],
    )


def build_marts(wh: Mapping[str, DataFrame], settings: Settings = Settings()) -> Frames:
    """All nine marts. Pass stored or materialized warehouse tables: the facts are read often."""
    built = Frames(
        {
            "customer_rfm": lambda: customer_rfm(wh["fact_orders"], wh["dim_customers"], settings),
            "monthly_sales": lambda: monthly_sales(wh["fact_orders"], wh["dim_date"], settings),
            "category_performance": lambda: category_performance(
                wh["fact_order_items"], wh["dim_products"], settings
            ),
            "delivery_by_state": lambda: delivery_by_state(
                wh["fact_orders"], wh["dim_customers"], wh["fact_order_items"], settings
            ),
            "satisfaction_vs_delivery": lambda: satisfaction_vs_delivery(wh["fact_orders"], settings),
            "data_quality": lambda: data_quality(wh["fact_orders"], wh["fact_order_items"], settings),
            "payment_outliers": lambda: payment_outliers(wh["fact_orders"], settings),
            "delivery_outliers": lambda: delivery_outliers(wh["fact_orders"], settings),
            "risk_register": lambda: risk_register(
                built["customer_rfm"], built["delivery_by_state"], built["payment_outliers"], settings
            ),
        }
    )
    return built
