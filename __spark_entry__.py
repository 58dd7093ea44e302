"""Every operator as a query over the given tables, and the SQL each has to agree with."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import oracles
from tradewind.lazy import Frames
from tradewind.operators.quality import run_checks, summary
from tradewind.operators.scratch import materialize, scratch_path
from tradewind.plans import dashboard as d
from tradewind.plans import marts as m
from tradewind.plans import reports as r
from tradewind.plans import warehouse as w
from tradewind.plans.checks import WAREHOUSE_CHECKS
from tradewind.session import tune
from tradewind.sources.csv_load import Loaded, load_csv
from tradewind.sources.raw import RAW_SCHEMAS, stage
from tradewind.sources.retail import RETAIL_SETTINGS as S
from tradewind.sources.retail import marketplace_tables
from tradewind.sources.sink import row_counts
from tradewind.sql import Sql

try:  # the text operators are an optional part, with third-party modules of their own
    import corpus_pipeline
    from tradewind.llm import queries as llm
except ImportError as missing:
    if getattr(missing, "name", None) not in ("corpus_pipeline", "tradewind.llm"):
        warnings.warn(f"the text operators are left out: {missing}", stacklevel=1)
    corpus_pipeline = llm = None

SCATTER_STATES = ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8"]

# What the marts, the checks and the reports read of the order fact.
ORDER_COLUMNS = [
    "order_id",
    "customer_key",
    "purchase_date_key",
    "order_status",
    "purchased_at",
    "delivered_at",
    "delivery_delay_days",
    "total_payment",
    "avg_review_score",
]

ITEM_COLUMNS = [
    "order_id",
    "order_item_id",
    "product_key",
    "seller_key",
    "price",
    "freight_value",
    "freight_ratio",
    "avg_review_score",
    "delivery_delay_days",
    "order_status",
]


class Tables:
    """Warehouse and marts over one folder, each built when a query first asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder
        self.staged = stage(marketplace_tables(spark, folder))

    @cached_property
    def warehouse(self) -> Frames:
        """The item fact joins the stored order fact: both sides of that join are then plain
        shuffles, which adaptive execution can split where one order holds very many lines."""
        return w.build_warehouse(self.staged, self.spark, S).replacing(
            fact_order_items=lambda: w.fact_order_items(self.staged["order_items"], self.stored_orders)
        )

    @cached_property
    def stored_orders(self) -> DataFrame:
        """The order fact, written once for queries that read it in several jobs."""
        return materialize(self.warehouse["fact_orders"].select(*ORDER_COLUMNS), "fact_orders")

    @cached_property
    def stored_items(self) -> DataFrame:
        return materialize(self.warehouse["fact_order_items"].select(*ITEM_COLUMNS), "fact_order_items")

    @cached_property
    def stored_warehouse(self) -> Frames:
        return self.warehouse.replacing(
            fact_orders=lambda: self.stored_orders,
            fact_order_items=lambda: self.stored_items,
        )

    @cached_property
    def history(self) -> DataFrame:
        wh = self.warehouse
        return m.rfm_customer_orders(wh["fact_orders"], wh["dim_customers"], S)

    @cached_property
    def rfm(self) -> DataFrame:
        wh = self.warehouse
        return m.customer_rfm(wh["fact_orders"], wh["dim_customers"], S)

    @cached_property
    def monthly(self) -> DataFrame:
        return m.monthly_sales(self.warehouse["fact_orders"], self.warehouse["dim_date"], S)

    @cached_property
    def categories(self) -> DataFrame:
        wh = self.warehouse
        return m.category_performance(wh["fact_order_items"], wh["dim_products"], S)

    @cached_property
    def by_state(self) -> DataFrame:
        wh = self.warehouse
        return m.delivery_by_state(self.stored_orders, wh["dim_customers"], wh["fact_order_items"], S)

    @cached_property
    def satisfaction(self) -> DataFrame:
        return m.satisfaction_vs_delivery(self.warehouse["fact_orders"], S)

    @cached_property
    def profile(self) -> DataFrame:
        return m.data_quality(self.stored_orders, self.warehouse["fact_order_items"], S)

    @cached_property
    def payment_outliers(self) -> DataFrame:
        return m.payment_outliers(
            self._delivered("total_payment", "customer_key", "purchased_at"), S
        )

    @cached_property
    def delivery_outliers(self) -> DataFrame:
        columns = ("delivery_delay_days", "customer_key", "purchased_at", "avg_review_score")
        return m.delivery_outliers(self._delivered(*columns), S)

    def _delivered(self, *columns: str) -> DataFrame:
        """Delivered orders with the wanted columns, written once for a three-pass operator."""
        orders = self.warehouse["fact_orders"].filter(F.col("order_status") == S.delivered_status)
        return materialize(orders.select("order_id", "order_status", *columns), "delivered")

    @cached_property
    def opportunity(self) -> DataFrame:
        return r.geo_opportunity(self.warehouse["dim_customers"], self.warehouse["dim_sellers"])

    @cached_property
    def states(self) -> DataFrame:
        return d.state_map(self.by_state, self.warehouse["dim_sellers"])

    @cached_property
    def kpi(self) -> DataFrame:
        return r.kpi_summary(self.warehouse["fact_orders"], S)

    @cached_property
    def risks(self) -> DataFrame:
        orders_stored = self.warehouse.replacing(fact_orders=lambda: self.stored_orders)
        return m.build_marts(orders_stored, S)["risk_register"]

    @cached_property
    def marts(self) -> Frames:
        return m.build_marts(self.stored_warehouse, S)

    @cached_property
    def sql(self) -> Sql:
        read = ("fact_orders", "dim_customers", "dim_sellers")
        return Sql(self.spark, warehouse={name: self.warehouse[name] for name in read})

    def check(self, name: str) -> DataFrame:
        wh, (check,) = self.warehouse, [c for c in WAREHOUSE_CHECKS if c.name == name]
        if check.table == "fact_order_items":
            wh = wh.replacing(fact_orders=lambda: self.stored_orders)
        return run_checks(wh, [check])

    @cached_property
    def quality(self) -> DataFrame:
        return run_checks(self.stored_warehouse, WAREHOUSE_CHECKS)

    @cached_property
    def csv_reviews(self) -> Loaded:
        """The documents as free-text reviews, written as CSV and loaded again in parallel."""
        documents = self.spark.read.parquet(f"{self.folder}/documents.parquet")
        reviews = documents.selectExpr(
            "cast(doc_id as string) as review_id",
            "cast(doc_id div 2 as string) as order_id",
            "cast(1 + doc_id % 5 as int) as review_score",
            "source as review_comment_title",
            "text as review_comment_message",
            "timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(cast(doc_id % 365 as int)) as review_creation_date",
            "cast(null as timestamp_ntz) as review_answer_timestamp",
        )
        path = scratch_path(self.spark, "reviews-csv")
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        reviews.write.options(**options).csv(path)
        return load_csv(self.spark, path, "reviews", RAW_SCHEMAS["reviews"], multiline=True)

    @cached_property
    def csv_payments(self) -> Loaded:
        """The payments as lines of text, some of them broken: a value of the wrong type, a row too short or too long."""
        lines = self.spark.read.parquet(f"{self.folder}/lineitem.parquet").selectExpr(
            """concat_ws(',', l_orderkey, if(l_orderkey % 31 = 0, 'first', cast(l_linenumber as string)), 'boleto',
               if(l_orderkey % 37 = 0, null, '1'), if(l_orderkey % 41 = 0, 'n/a', cast(l_partkey as string)),
               if(l_orderkey % 43 = 0, 'more', null)) as line"""
        )
        path = scratch_path(self.spark, "payments-csv")
        lines.write.text(path)
        return load_csv(self.spark, path, "payments", RAW_SCHEMAS["payments"], header=False)

    @cached_property
    def payload(self) -> DataFrame:
        wh = self.stored_warehouse
        orders, items, customers = wh["fact_orders"], wh["fact_order_items"], wh["dim_customers"]
        rfm = materialize(m.customer_rfm(orders, customers, S), "customer_rfm")
        return d.dashboard_payload(
            r.kpi_summary(orders, S),
            r.repeat_purchase(rfm),
            d.state_map(m.delivery_by_state(orders, customers, items, S), wh["dim_sellers"]),
            m.monthly_sales(orders, wh["dim_date"], S),
            rfm,
            m.category_performance(items, wh["dim_products"], S),
        )


# Statements as an analyst writes them, over the tables by name.
STATEMENTS = {
    "sql_headline": """
        SELECT count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_key) AS unique_customers,
               scaled_round(sum(total_payment), 0) AS total_revenue, scaled_round(avg(total_payment), 2) AS avg_order_value,
               sum(CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END) AS late_orders
        FROM {warehouse}.fact_orders WHERE order_status NOT IN ('canceled', 'unavailable')""",
    "sql_customers_per_seller": """
        WITH customer_state AS (SELECT state, count(*) AS customers FROM {warehouse}.dim_customers GROUP BY state),
             seller_state AS (SELECT state, count(*) AS sellers FROM {warehouse}.dim_sellers GROUP BY state)
        SELECT c.state, c.customers, coalesce(s.sellers, 0) AS sellers,
               scaled_round(ratio(c.customers, coalesce(s.sellers, 0)), 1) AS customers_per_seller
        FROM customer_state c LEFT JOIN seller_state s USING (state)""",
    "sql_delays": """
        SELECT delivery_bucket(delivery_delay_days) AS bucket, count(*) AS orders,
               scaled_round(pct(count(*), sum(count(*)) OVER ()), 1) AS share
        FROM {warehouse}.fact_orders WHERE delivery_delay_days IS NOT NULL GROUP BY 1""",
    "sql_weekdays": """
        SELECT weekday_from_sunday(cast(purchased_at AS DATE)) AS weekday, month_label(year(purchased_at), month(purchased_at)) AS month,
               max(month_boundaries(cast(purchased_at AS DATE), cast(delivered_at AS DATE))) AS most_months, count(*) AS orders
        FROM {warehouse}.fact_orders GROUP BY 1, 2""",
    "sql_high_payments": """
        SELECT order_status, count(*) AS orders, scaled_round(max(total_payment), 2) AS most,
               scaled_round(sum(total_payment), 2) AS total
        FROM {warehouse}.fact_orders WHERE total_payment > 0 GROUP BY order_status""",
}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that every engine's client shows the same value."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources and sinks
    "stage_tables": lambda t: row_counts(t.staged),
    "load_multiline_csv": lambda t: t.csv_reviews.rows.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        F.length("review_comment_message").alias("n_chars"),
        F.md5(F.col("review_comment_message").cast("binary")).alias("message_md5"),
        F.date_format("review_creation_date", "yyyy-MM-dd").alias("created"),
    ),
    "load_accepted": lambda t: t.csv_payments.rows.drop("payment_type"),
    "load_rejects": lambda t: t.csv_payments.rejects.select("table_name", "record", "reason"),
    "load_counts": lambda t: t.csv_payments.counts.unionByName(t.csv_reviews.counts),
    "row_counts": lambda t: row_counts(t.warehouse),
    "mart_row_counts": lambda t: row_counts(t.marts),
    "dashboard_payload": lambda t: t.payload,
    # warehouse
    "dim_customers": lambda t: t.warehouse["dim_customers"],
    "geo_zip_centroid": lambda t: w.geo_zip_centroid(t.staged["geolocation"]),
    "dim_sellers": lambda t: t.warehouse["dim_sellers"],
    "dim_products": lambda t: t.warehouse["dim_products"],
    "payment_agg": lambda t: w.payment_agg(t.staged["order_payments"]),
    "review_agg": lambda t: w.review_agg(t.staged["order_reviews"]),
    "fact_orders": lambda t: t.warehouse["fact_orders"],
    "fact_order_items": lambda t: t.warehouse["fact_order_items"],
    # marts
    "customer_rfm": lambda t: t.rfm,
    "rfm_snapshot_date": lambda t: m.rfm_snapshot_date(t.warehouse["fact_orders"]),
    "rfm_customer_orders": lambda t: t.history,
    "rfm_scores": lambda t: m.rfm_scores(t.history, S),
    "rfm_segment": lambda t: m.rfm_segment(m.rfm_scores(t.history, S), S),
    "annualised_clv": lambda t: m.annualised_clv(t.history).select("customer_key", "annualised_clv"),
    "monthly_sales": lambda t: t.monthly,
    "category_performance": lambda t: t.categories,
    "delivery_by_state": lambda t: t.by_state,
    "satisfaction_vs_delivery": lambda t: t.satisfaction,
    "data_quality": lambda t: t.profile,
    "payment_outliers": lambda t: t.payment_outliers,
    "delivery_outliers": lambda t: t.delivery_outliers,
    "risk_register": lambda t: t.risks,
    "risk_churn": lambda t: m.risk_churn(t.rfm),
    "risk_delivery": lambda t: m.risk_delivery(t.by_state),
    "risk_geo": lambda t: m.risk_geo(t.by_state, S),
    "risk_payment": lambda t: m.risk_payment(t.payment_outliers),
    # checks
    "quality_report": lambda t: t.quality,
    "quality_summary": lambda t: summary(t.quality),
    # reports
    "kpi_summary": lambda t: t.kpi,
    "repeat_purchase": lambda t: r.repeat_purchase(t.history),
    "repeat_revenue_share": lambda t: r.repeat_revenue_share(t.history),
    "churn_pct": lambda t: r.churn_pct(r.repeat_purchase(t.history)),
    "segment_share": lambda t: r.segment_share(t.rfm),
    "segment_share_spend": lambda t: r.segment_share_spend(t.rfm),
    "segment_summary": lambda t: r.segment_summary(t.rfm),
    "monthly_trend": lambda t: r.monthly_trend(t.monthly),
    "peak_month": lambda t: r.peak_month(t.monthly),
    "total_revenue_period": lambda t: r.total_revenue_period(t.monthly),
    "top_categories": lambda t: r.top_categories(t.categories, 15),
    "top_categories_5": lambda t: r.top_categories(t.categories, 5),
    "category_label": lambda t: r.category_label(t.categories),
    "top_states": lambda t: r.top_states(t.by_state),
    "delivery_review_pivot": lambda t: r.delivery_review_pivot(t.satisfaction),
    "delivery_review_pct": lambda t: r.delivery_review_pct(r.delivery_review_pivot(t.satisfaction)),
    "geo_opportunity": lambda t: t.opportunity,
    "underserved_states": lambda t: r.underserved_states(t.opportunity, S),
    "sellers_by_state": lambda t: r.sellers_by_state(t.warehouse["dim_sellers"]),
    "state_map": lambda t: t.states,
    "state_map_bands": lambda t: d.state_map_bands(t.states),
    "state_map_radius": lambda t: d.state_map_radius(t.states),
    "state_filter_scatter": lambda t: d.state_filter_scatter(t.states, SCATTER_STATES),
    "payment_outlier_summary": lambda t: r.payment_outlier_summary(t.payment_outliers),
    "delivery_outlier_summary": lambda t: r.delivery_outlier_summary(t.delivery_outliers),
    "top_payment_outliers": lambda t: r.top_payment_outliers(t.payment_outliers),
    "payment_histogram": lambda t: r.payment_histogram(t.warehouse["fact_orders"], S),
    "risk_scored": lambda t: r.risk_scored(t.risks),
    "risk_matrix": lambda t: r.risk_matrix(t.risks),
    "data_quality_pct": lambda t: r.data_quality_pct(t.profile),
    "cleaning_funnel": lambda t: r.cleaning_funnel(t.profile),
    "late_order_rate": lambda t: r.late_order_rate(t.kpi),
    "revenue_scaled": lambda t: r.revenue_scaled(t.kpi, t.categories),
}


def _query(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(Tables(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    checks = {
        f"check_{c.name}": _query(lambda t, name=c.name: t.check(name)) for c in WAREHOUSE_CHECKS
    }
    texts = {"pipeline": corpus_pipeline.run, **llm.QUERIES} if llm else {}
    statements = {name: _query(lambda t, text=text: t.sql.q(text)) for name, text in STATEMENTS.items()}
    return {name: _query(build) for name, build in QUERIES.items()} | checks | statements | texts


def oracle_sql() -> dict[str, str]:
    texts = llm.ORACLES if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        texts = texts | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: oracles.oracle(name) for name in queries() if name in oracles.ANSWERS} | texts


def entry(spark: SparkSession) -> DataFrame:
    return queries()["customer_rfm"](spark, "/root/testdata/sf0.001")
