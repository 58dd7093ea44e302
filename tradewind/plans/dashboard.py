"""Figures of the state map and the dashboard's JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.dates import month_label
from tradewind.functions.labels import state_lookup, title_label
from tradewind.functions.numeric import banded, round_half_even, safe_ratio
from tradewind.plans.reports import sellers_by_state, segment_share_spend, top_categories


def state_map(by_state: DataFrame, sellers: DataFrame) -> DataFrame:
    """Delivery figures per state with seller counts, names and map positions."""
    n = F.coalesce("seller_count", F.lit(0))
    spark = by_state.sparkSession
    return (
        by_state.withColumnRenamed("customer_state", "state")
        .join(sellers_by_state(sellers), "state", "left")
        .join(F.broadcast(state_lookup(spark)), "state", "left")
        .select(
            "state",
            "total_orders",
            "avg_delay_days",
            "late_count",
            "late_pct",
            "avg_review_score",
            "avg_freight_value",
            n.alias("seller_count"),
            round_half_even(safe_ratio(F.col("total_orders"), F.greatest(n, F.lit(1))), 1).alias("cs_ratio"),
            F.coalesce("state_name", "state").alias("state_name"),
            F.coalesce("lat", F.lit(0.0)).alias("lat"),
            F.coalesce("lng", F.lit(0.0)).alias("lng"),
        )
        .orderBy(F.desc("total_orders"), "state")
    )


def _share_of_max(column: str) -> Column:
    # Over one row per state.
    return safe_ratio(F.col(column), F.max(column).over(Window.partitionBy()))


def state_map_bands(states: DataFrame) -> DataFrame:
    """Colour band of each state in the four map views, lightest or best first."""
    return states.select(
        "state",
        banded(_share_of_max("total_orders"), [0.10, 0.30, 0.60]).alias("orders_band"),
        banded(F.col("late_pct"), [4, 8, 12, 16]).alias("delivery_band"),
        banded(F.col("avg_review_score"), [4.3, 4.0, 3.7, 3.4], descending=True).alias("review_band"),
        banded(_share_of_max("cs_ratio"), [0.15, 0.35, 0.60]).alias("opportunity_band"),
    )


def state_map_radius(states: DataFrame) -> DataFrame:
    """Bubble radius of each state in the four map views."""
    return states.select(
        "state",
        (8 + _share_of_max("total_orders") * 26).alias("orders_radius"),
        (8 + F.col("late_pct") / 20 * 22).alias("delivery_radius"),
        (8 + (5 - F.col("avg_review_score")) / 2 * 20).alias("review_radius"),
        (8 + _share_of_max("cs_ratio") * 26).alias("opportunity_radius"),
    )


def state_filter_scatter(states: DataFrame, chosen: list[str] | None = None) -> DataFrame:
    """Delay against review for the chosen states, bubbles scaled to the largest of them."""
    kept = states if chosen is None else states.filter(F.col("state").isin(*chosen))
    return kept.select(
        "state",
        "avg_delay_days",
        "avg_review_score",
        "late_pct",
        (10 + _share_of_max("total_orders") * 28).alias("marker_size"),
    )


def dashboard_payload(
    kpi: DataFrame,
    repeat: DataFrame,
    states: DataFrame,
    monthly: DataFrame,
    rfm: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """One JSON document: headline figures and one array per chart."""

    def only(df: DataFrame, *columns) -> Column:
        return df.select(F.struct(*columns)).scalar()

    def listed(df: DataFrame, order: list[Column], *columns) -> Column:
        """Rows as an array, in the given order; for charts of a few dozen marks."""
        ranked = F.row_number().over(Window.partitionBy().orderBy(*order))
        rows = df.select(ranked.alias("place"), F.struct(*columns).alias("mark"))
        marks = F.array_sort(F.collect_list(F.struct("place", "mark")))
        return rows.agg(F.transform(marks, lambda m: m["mark"])).scalar()

    def fixed(column: str, digits: int) -> Column:
        """A number with a fixed count of decimals, which JSON writes out plainly."""
        return F.col(column).cast(f"decimal(18,{digits})")

    head = only(
        kpi,
        "total_orders",
        "unique_customers",
        fixed("total_revenue", 2).alias("total_revenue"),
        fixed("avg_order_value", 2).alias("avg_order_value"),
        fixed("avg_review_score", 2).alias("avg_review_score"),
        "late_orders",
    )
    repeated = only(
        repeat,
        fixed("repeat_pct", 1).alias("repeat_pct"),
        fixed("avg_repeat", 2).alias("avg_repeat"),
        fixed("avg_onetime", 2).alias("avg_onetime"),
    )
    # Each subquery is named once and then taken apart, so that it is planned once.
    parts = {
        "head": head,
        "repeated": repeated,
        "byState": listed(
            states,
            [F.desc("total_orders"), F.asc("state")],
            "state",
            F.col("state_name").alias("name"),
            "lat",
            "lng",
            "total_orders",
            fixed("avg_review_score", 2).alias("avg_review_score"),
            fixed("late_pct", 1).alias("late_pct"),
            round_half_even(F.col("avg_delay_days"), 1).cast("decimal(18,1)").alias("avg_delay_days"),
            fixed("avg_freight_value", 2).alias("avg_freight_value"),
            "seller_count",
            fixed("cs_ratio", 1).alias("cs_ratio"),
        ),
        "monthly": listed(
            monthly,
            [F.asc("year"), F.asc("month")],
            month_label(F.col("year"), F.col("month")).alias("label"),
            "month_name",
            fixed("total_revenue", 2).alias("revenue"),
            F.col("total_orders").alias("orders"),
            fixed("avg_order_value", 2).alias("avg_value"),
            fixed("avg_review_score", 2).alias("avg_review"),
            F.col("late_deliveries").alias("late"),
        ),
        "rfm": listed(
            segment_share_spend(rfm),
            [F.desc("n"), F.asc("segment")],
            "segment",
            F.col("n").alias("count"),
            fixed("pct", 1).alias("pct"),
            fixed("avg_spend", 2).alias("avg_spend"),
        ),
        "categories": listed(
            top_categories(categories, 10),
            [F.desc("total_revenue"), F.asc("category")],
            title_label(F.col("category")).alias("category"),
            fixed("total_revenue", 2).alias("revenue"),
            F.col("units_sold").alias("units"),
            fixed("avg_review_score", 2).alias("review"),
            fixed("avg_freight_ratio", 3).alias("freight_ratio"),
        ),
    }
    document = F.struct(
        F.struct("head.*", "repeated.*").alias("kpi"), *[name for name in parts if name not in ("head", "repeated")]
    )
    return (
        states.sparkSession.range(1)
        .select(*[value.alias(name) for name, value in parts.items()])
        .select(F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"))
    )
