"""Full refresh: raw tables to stored warehouse, stored marts and a quality report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.quality import all_passed, violations
from tradewind.operators.scratch import materialize, scratch_scope
from tradewind.plans.checks import WAREHOUSE_CHECKS, quality_report
from tradewind.plans.marts import build_marts, risk_register
from tradewind.plans.warehouse import (
    ORDER_ATTRIBUTES,
    PURCHASE_MONTH,
    build_warehouse,
    fact_order_items,
    geo_zip_centroid,
    with_purchase_month,
)
from tradewind.settings import Settings
from tradewind.sources.csv_load import CsvLoad
from tradewind.sources.raw import stage
from tradewind.sources.sink import ROWS, ensure_database, observations, write_table
from tradewind.steps import Step, run_steps


@dataclass(frozen=True)
class Built:
    warehouse: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    quality: DataFrame


# The tables of each layer, in the order they are listed.
WAREHOUSE = ("dim_date", "dim_customers", "dim_sellers", "dim_products", "fact_orders", "fact_order_items")
MARTS = (
    "customer_rfm",
    "monthly_sales",
    "category_performance",
    "delivery_by_state",
    "satisfaction_vs_delivery",
    "data_quality",
    "payment_outliers",
    "delivery_outliers",
    "risk_register",
)
RUN = "tradewind.run"  # table property: the run that stored the table


def _stored(spark: SparkSession, database: str, name: str, run_id: str | None, build: Callable[[], DataFrame], **layout) -> DataFrame:
    """Builds and stores a table, unless this very run has stored it before it was interrupted."""
    table = f"`{database}`.`{name}`"
    if run_id and spark.catalog.tableExists(table):
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        if properties.get(RUN) == run_id:
            return spark.table(table)
    stored = write_table(build(), database, name, **layout)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{RUN}' = '{run_id or ''}')")
    return stored


def store_warehouse(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    database: str,
    settings: Settings = Settings(),
    buckets: int = 0,
    parallel: int = 4,
    run_id: str | None = None,
    by_month: bool = False,
) -> dict[str, DataFrame]:
    """Build the six warehouse tables and store each; the item fact reads a stored order fact.

    Tables that don't need each other are built at the same time, up to ``parallel``. With ``run_id``, those that a run of
    this name has stored are left as they are. With ``buckets`` both facts are bucketed by order, which spares later joins
    a shuffle. The item join itself reads an unbucketed copy: its tasks don't depend on the number of buckets. With
    ``by_month`` the facts are stored by month of purchase, and whoever asks for some years reads their files only.
    """
    ensure_database(spark, database)
    staged = stage(raw)
    centroids: list[DataFrame] = []
    layout = {"bucket_by": "order_id", "buckets": buckets, "partition_by": (PURCHASE_MONTH,) if by_month else ()}
    dated = with_purchase_month if by_month else lambda fact: fact
    checked = {fact: violations(fact, WAREHOUSE_CHECKS) for fact in ("fact_orders", "fact_order_items")}

    def built(name: str) -> DataFrame:
        return build_warehouse(staged, spark, settings, *centroids)[name]

    def items() -> DataFrame:
        orders = spark.table(f"`{database}`.`fact_orders`")
        if buckets:
            orders = materialize(orders.select(*ORDER_ATTRIBUTES), "order_attributes")
        return dated(fact_order_items(staged["order_items"], orders))

    def store(name: str, build: Callable[[], DataFrame], **how) -> Callable[[], DataFrame]:
        return lambda: _stored(spark, database, name, run_id, build, **how)

    places = ("centroids",)
    steps = {
        "centroids": Step(lambda: centroids.append(materialize(geo_zip_centroid(staged["geolocation"]), "centroids"))),
        "dim_date": Step(store("dim_date", lambda: built("dim_date"))),
        "dim_customers": Step(store("dim_customers", lambda: built("dim_customers")), places),
        "dim_sellers": Step(store("dim_sellers", lambda: built("dim_sellers")), places),
        "dim_products": Step(store("dim_products", lambda: built("dim_products"))),
        "fact_orders": Step(store("fact_orders", lambda: dated(built("fact_orders")), observed=checked["fact_orders"], **layout)),
        "fact_order_items": Step(
            store("fact_order_items", items, observed=checked["fact_order_items"], **layout), ("fact_orders",)
        ),
    }
    done = run_steps(steps, parallel)
    return {name: done[name] for name in WAREHOUSE}


def store_marts(
    spark: SparkSession,
    wh: Mapping[str, DataFrame],
    database: str,
    settings: Settings = Settings(),
    parallel: int = 4,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Build and store the nine marts, several at a time; the risk register reads the stored marts it rests on."""
    ensure_database(spark, database)
    rests_on = ("customer_rfm", "delivery_by_state", "payment_outliers")

    def build(name: str) -> DataFrame:
        if name == "risk_register":
            return risk_register(*[spark.table(f"`{database}`.`{mart}`") for mart in rests_on], settings)
        return build_marts(wh, settings)[name]

    steps = {
        name: Step(
            lambda name=name: _stored(spark, database, name, run_id, lambda: build(name)),
            rests_on if name == "risk_register" else (),
        )
        for name in MARTS
    }
    done = run_steps(steps, parallel)
    return {name: done[name] for name in MARTS}


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame] | CsvLoad,
    warehouse_db: str = "warehouse",
    marts_db: str = "marts",
    settings: Settings = Settings(),
    buckets: int = 0,
    stop_on_failed_checks: bool = False,
    parallel: int = 4,
    run_id: str | None = None,
    by_month: bool = False,
) -> Built:
    """The whole refresh; scratch tables are gone when it ends.

    Up to ``parallel`` tables that don't need each other are built at the same time. Under a ``run_id`` that was
    interrupted, the tables it has stored are kept and only the others are built.

    Of a CSV load, the quality report also counts the rejected rows of each raw table. With
    ``stop_on_failed_checks`` the checks run before the marts, and a failed one raises.
    """
    with scratch_scope(spark):
        tables = raw.tables if isinstance(raw, CsvLoad) else raw
        warehouse = store_warehouse(spark, tables, warehouse_db, settings, buckets, parallel, run_id, by_month)
        # Row checks of the facts were counted as the facts were written; only keys are looked at again.
        known: dict[str, int] = {}
        for fact in ("fact_orders", "fact_order_items"):
            known |= observations(warehouse_db, fact, warehouse[fact])
        known.pop(ROWS, None)
        quality = quality_report(warehouse, known=known)
        if isinstance(raw, CsvLoad):
            # The load's tables go with the scope; its report, one row per table, stays.
            quality = quality.unionByName(spark.createDataFrame(raw.report().collect(), quality.schema))
        if stop_on_failed_checks and not all_passed(quality):
            raise ValueError("data-quality checks failed")
        return Built(warehouse, store_marts(spark, warehouse, marts_db, settings, parallel, run_id), quality)
