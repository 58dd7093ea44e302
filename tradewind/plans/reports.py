"""Report queries over the warehouse and the marts.

Inputs named after a mart are that mart's rows. A window without partitions appears
only over per-segment, per-state or per-month rows, whose number the business fixes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradewind.functions.dates import month_label
from tradewind.functions.labels import LEVEL_SCORES, level_score, risk_level, title_label
from tradewind.functions.numeric import (
    exact_avg,
    exact_avg_of_ints,
    exact_avg_of_scores,
    exact_sum,
    percent,
    round_half_away,
    round_half_even,
    safe_ratio,
)
from tradewind.operators.scratch import materialize
from tradewind.plans.marts import DELIVERY_BUCKETS
from tradewind.settings import Settings

SCORES = [1, 2, 3, 4, 5]


# ---------------------------------------------------------------- headline figures


def kpi_summary(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    delay = exact_avg_of_ints(F.col("delivery_delay_days"))
    sold = orders.filter(~F.col("order_status").isin(*settings.excluded_statuses)).select(
        "order_id", "customer_key", "total_payment", "avg_review_score", "delivery_delay_days"
    )
    sold = materialize(sold, "sold_orders")

    def distinct(column: str) -> Column:
        return sold.select(column).distinct().agg(F.count(column)).scalar()

    summed = sold.agg(
        round_half_away(exact_sum(F.col("total_payment")), 0).alias("total_revenue"),
        round_half_away(exact_avg(F.col("total_payment")), 2).alias("avg_order_value"),
        round_half_away(exact_avg_of_scores(F.col("avg_review_score")), 2).alias("avg_review_score"),
        round_half_away(delay, 2).alias("avg_delivery_delay"),
        round_half_away(F.abs(delay), 2).alias("avg_days_early"),
        F.sum(F.when(F.col("delivery_delay_days") > 0, 1).otherwise(0)).alias("late_orders"),
    )
    return summed.select(
        distinct("order_id").alias("total_orders"),
        distinct("customer_key").alias("unique_customers"),
        *summed.columns,
    )


def late_order_rate(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "late_orders",
        "total_orders",
        percent(F.col("late_orders"), F.col("total_orders")).alias("late_order_pct"),
    )


def repeat_purchase(rfm: DataFrame) -> DataFrame:
    again, once = F.col("frequency") > 1, F.col("frequency") == 1
    return rfm.agg(
        F.count_if(again).alias("repeat_buyers"),
        F.count("*").alias("total_customers"),
        round_half_away(percent(F.count_if(again), F.count("*")), 1).alias("repeat_pct"),
        round_half_away(exact_avg(F.when(once, F.col("monetary"))), 2).alias("avg_onetime"),
        round_half_away(exact_avg(F.when(again, F.col("monetary"))), 2).alias("avg_repeat"),
    )


def repeat_revenue_share(rfm: DataFrame) -> DataFrame:
    repeat = F.coalesce(exact_sum(F.when(F.col("frequency") > 1, F.col("monetary"))), F.lit(0.0))
    total = exact_sum(F.col("monetary"))
    return rfm.agg(
        repeat.alias("repeat_revenue"),
        total.alias("total_revenue"),
        percent(repeat, total).alias("repeat_revenue_pct"),
    )


def churn_pct(repeat: DataFrame) -> DataFrame:
    return repeat.select(round_half_away(F.lit(100.0) - F.col("repeat_pct"), 1).alias("churn_pct"))


# ---------------------------------------------------------------- segments


def _segment_counts(rfm: DataFrame) -> DataFrame:
    everyone = F.sum("n").over(Window.partitionBy())
    return (
        rfm.groupBy("segment")
        .agg(F.count("*").alias("n"), exact_sum(F.col("monetary")).alias("total_revenue"))
        .withColumn("share", percent(F.col("n"), everyone))
    )


def segment_share(rfm: DataFrame) -> DataFrame:
    return (
        _segment_counts(rfm)
        .select("segment", "n", round_half_away(F.col("share"), 1).alias("pct"))
        .orderBy(F.desc("n"), "segment")
    )


def segment_share_spend(rfm: DataFrame) -> DataFrame:
    spend = round_half_away(safe_ratio(F.col("total_revenue"), F.col("n")), 2)
    return (
        _segment_counts(rfm)
        .select("segment", "n", round_half_away(F.col("share"), 1).alias("pct"), spend.alias("avg_spend"))
        .orderBy(F.desc("n"), "segment")
    )


def segment_summary(rfm: DataFrame) -> DataFrame:
    return (
        _segment_counts(rfm)
        .select("segment", F.col("n").alias("count"), F.col("share").alias("pct"), "total_revenue")
        .orderBy(F.desc("total_revenue"), "segment")
    )


# ---------------------------------------------------------------- months


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        month_label(F.col("year"), F.col("month")).alias("month_label"),
        *monthly.columns,
        round_half_even(F.col("total_revenue"), 0).alias("revenue_rounded"),
        safe_ratio(F.col("total_revenue"), F.lit(1000.0)).alias("revenue_thousands"),
    ).orderBy("month_start")


def peak_month(monthly: DataFrame) -> DataFrame:
    """The month of highest revenue, the earliest one on ties."""
    return (
        monthly.select(
            month_label(F.col("year"), F.col("month")).alias("month_label"),
            "year",
            "month",
            "month_name",
            "total_orders",
            "total_revenue",
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "year", "month")
        .limit(1)
    )


def total_revenue_period(monthly: DataFrame) -> DataFrame:
    return monthly.agg(exact_sum(F.col("total_revenue")).alias("total_revenue"))


# ---------------------------------------------------------------- categories


def top_categories(categories: DataFrame, k: int) -> DataFrame:
    return (
        categories.select(
            "category", "total_revenue", "units_sold", "avg_price", "avg_freight_ratio", "avg_review_score"
        )
        .orderBy(F.desc("total_revenue"), "category")
        .limit(k)
    )


def category_label(categories: DataFrame) -> DataFrame:
    return categories.select("category", title_label(F.col("category")).alias("label"), "total_revenue")


def revenue_scaled(kpi: DataFrame, categories: DataFrame, k: int = 8) -> DataFrame:
    """Total revenue in millions and the top categories in thousands."""
    total = kpi.select(
        F.lit("millions").alias("unit"),
        F.lit("all").alias("label"),
        round_half_away(safe_ratio(F.col("total_revenue"), F.lit(1e6)), 2).alias("revenue"),
    )
    parts = top_categories(categories, k).select(
        F.lit("thousands").alias("unit"),
        title_label(F.col("category")).alias("label"),
        round_half_even(safe_ratio(F.col("total_revenue"), F.lit(1000.0)), 1).alias("revenue"),
    )
    return total.unionByName(parts)


# ---------------------------------------------------------------- delivery and places


def top_states(by_state: DataFrame, k: int = 15) -> DataFrame:
    return (
        by_state.select("customer_state", "avg_review_score", "avg_delay_days", "total_orders", "late_pct")
        .orderBy(F.desc("total_orders"), "customer_state")
        .limit(k)
    )


def delivery_review_pivot(satisfaction: DataFrame) -> DataFrame:
    """Orders per delivery bucket (rows, earliest first) and review score (columns)."""
    place = F.create_map(*[F.lit(x) for i, (name, _) in enumerate(DELIVERY_BUCKETS, 1) for x in (name, i)])
    return (
        satisfaction.groupBy("delivery_bucket")
        .pivot("review_score", SCORES)
        .agg(F.sum("order_count"))
        .fillna(0)
        .select(
            place[F.col("delivery_bucket")].alias("bucket_order"),
            "delivery_bucket",
            *[F.col(str(s)).alias(f"score_{s}") for s in SCORES],
        )
        .orderBy("bucket_order")
    )


def delivery_review_pct(pivot: DataFrame) -> DataFrame:
    """Each row of the pivot in per cent of its total."""
    total = reduce(lambda a, b: a + b, [F.col(f"score_{s}") for s in SCORES])
    return pivot.select(
        "bucket_order",
        "delivery_bucket",
        *[
            (safe_ratio(F.col(f"score_{s}"), total) * 100).alias(f"score_{s}")
            for s in SCORES
        ],
    )


def geo_opportunity(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    demand = customers.groupBy("state").agg(F.count("*").alias("customers"))
    supply = sellers.groupBy("state").agg(F.count("*").alias("sellers"))
    return (
        demand.join(supply, "state", "left")
        .withColumn("sellers", F.coalesce("sellers", F.lit(0)))
        .withColumn(
            "customers_per_seller",
            round_half_away(safe_ratio(F.col("customers"), F.col("sellers")), 1),
        )
        .orderBy(F.desc("customers"), "state")
    )


def underserved_states(opportunity: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return (
        opportunity.filter(
            (F.col("state") != settings.home_state)
            & (F.col("customers") >= settings.underserved_min_customers)
        )
        .orderBy(F.desc_nulls_last("customers_per_seller"), "state")
        .limit(settings.underserved_top)
    )


def sellers_by_state(sellers: DataFrame) -> DataFrame:
    return sellers.groupBy("state").agg(F.countDistinct("seller_key").alias("seller_count"))


# ---------------------------------------------------------------- outliers


def payment_outlier_summary(outliers: DataFrame) -> DataFrame:
    return outliers.groupBy("q1", "q3", "iqr", "lower_fence", "upper_fence").agg(
        F.count("*").alias("total_outliers"),
        F.count_if(F.col("outlier_flag") == "high_outlier").alias("high_outliers"),
        F.count_if(F.col("outlier_flag") == "low_outlier").alias("low_outliers"),
    )


def delivery_outlier_summary(outliers: DataFrame) -> DataFrame:
    late, early = F.col("outlier_flag") == "extreme_late", F.col("outlier_flag") == "extreme_early"

    def review(which):
        score = F.when(which, F.col("avg_review_score"))
        return round_half_away(exact_avg_of_scores(score), 2)

    return outliers.groupBy("lower_fence", "upper_fence").agg(
        F.count_if(late).alias("extreme_late"),
        F.count_if(early).alias("extreme_early"),
        review(late).alias("late_review"),
        review(early).alias("early_review"),
    )


def top_payment_outliers(outliers: DataFrame, k: int = 15) -> DataFrame:
    return (
        outliers.select("order_id", "total_payment", "z_score", "outlier_flag")
        .orderBy(F.desc("total_payment"), "order_id")
        .limit(k)
    )


def payment_histogram(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Equal-width bins over the capped payments, empty bins included; the last bin is closed."""
    bins = settings.histogram_bins
    paid = (
        orders.filter(
            (F.col("order_status") == settings.delivered_status) & (F.col("total_payment") > 0)
        )
        .select(F.least("total_payment", F.lit(settings.histogram_cap)).alias("payment"))
        .groupBy("payment")
        .agg(F.count("*").alias("n"))
    )
    paid = materialize(paid, "payment_counts")
    # One value only: a bin range of one around it, as the plotting library chooses.
    flat = F.min("payment") == F.max("payment")
    span = (
        paid.agg(
            F.when(flat, F.min("payment") - 0.5).otherwise(F.min("payment")).alias("low"),
            F.when(flat, F.max("payment") + 0.5).otherwise(F.max("payment")).alias("high"),
        )
        .select(F.struct("low", "high"))
        .scalar()
    )
    low, width = F.col("span.low"), F.col("span.high") - F.col("span.low")
    position = F.floor((F.col("payment") - low) * float(bins) / width)
    counted = (
        paid.withColumn("span", span)
        .groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("n").alias("n"))
    )

    def edge(bin_number):
        return low + width * bin_number / float(bins)

    return (
        orders.sparkSession.range(bins)
        .select(F.col("id").alias("bin"), span.alias("span"))
        .filter(low.isNotNull())
        .join(F.broadcast(counted), "bin", "left")  # a row per bin
        .select(
            (F.col("bin") + 1).cast("int").alias("bin"),
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


# ---------------------------------------------------------------- risks


def risk_scored(register: DataFrame) -> DataFrame:
    score = level_score(F.col("likelihood")) * level_score(F.col("impact"))
    return register.select(
        *register.columns, score.alias("risk_score"), risk_level(score).alias("risk_level")
    ).orderBy(F.desc("risk_score"), "risk_category")


def risk_matrix(scored: DataFrame) -> DataFrame:
    """All likelihood x impact cells, with the risk that falls in each."""
    scores = sorted(LEVEL_SCORES.values())
    side = F.array(*[F.lit(s) for s in scores])
    cells = (
        scored.sparkSession.range(1)
        .select(F.explode(side).alias("likelihood"))
        .select("likelihood", F.explode(side).alias("impact"))
    )
    risks = scored.groupBy(
        level_score(F.col("likelihood")).alias("likelihood"), level_score(F.col("impact")).alias("impact")
    ).agg(F.max("risk_category").alias("risk_category"))
    score = F.col("likelihood") * F.col("impact")
    return cells.join(risks, ["likelihood", "impact"], "left").select(
        "likelihood",
        "impact",
        score.alias("risk_score"),
        risk_level(score).alias("risk_level"),
        "risk_category",
    )


# ---------------------------------------------------------------- data quality


def data_quality_pct(profile: DataFrame) -> DataFrame:
    rows = F.col("total_rows")
    return profile.select(
        "table_name",
        "total_rows",
        percent(F.col("excluded_status"), rows).alias("pct_excluded"),
        percent(F.col("clean_delivered"), rows).alias("pct_clean"),
        percent(F.col("zero_payment"), rows).alias("pct_zero_payment"),
    )


def cleaning_funnel(profile: DataFrame) -> DataFrame:
    rows = F.col("total_rows")
    stages = [
        ("Raw orders", rows),
        ("After status exclusion", rows - F.col("excluded_status")),
        ("Clean delivered orders", F.col("clean_delivered")),
        ("Excluded by status filter", F.col("excluded_status")),
        ("Zero-value payments", F.col("zero_payment")),
    ]
    listed = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage_order"),
                F.lit(name).alias("stage"),
                n.alias("n"),
                percent(n, rows).alias("pct_of_raw"),
            )
            for i, (name, n) in enumerate(stages, 1)
        ]
    )
    return profile.filter(F.col("table_name") == "fact_orders").select(F.inline(listed))
