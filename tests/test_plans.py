"""What the physical plans must and must not contain."""

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tradewind.plans.marts import orders_of_sales_years
from tradewind.plans.warehouse import build_warehouse
from tradewind.sources.raw import stage
from tradewind.sources.retail import RETAIL_SETTINGS as S
from tradewind.sources.retail import marketplace_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    built = {}

    def get(name):
        if name not in built:
            built[name] = plan(entry.queries()[name](spark, FOLDER))
        return built[name]

    return get


LARGE = [
    "fact_orders", "fact_order_items", "dim_customers", "dim_products", "customer_rfm", "monthly_sales",
    "category_performance", "delivery_by_state", "satisfaction_vs_delivery", "payment_outliers",
    "delivery_outliers", "data_quality", "kpi_summary", "payment_histogram", "check_items_orders_fk",
]


@pytest.mark.parametrize("name", LARGE)
def test_no_cross_join_no_python_no_global_window(plans, name):
    text = plans(name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas|Arrow(Eval|Map)", text)
    assert not re.search(r"Window \[.*\n.*Sort .*\n.*Exchange SinglePartition", text)


def test_scans_read_only_the_columns_they_need(plans):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plans("satisfaction_vs_delivery"))
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert not columns & {"l_extendedprice", "props", "l_partkey", "l_suppkey"}


def test_unused_joins_disappear(plans):
    text = plans("rfm_snapshot_date")
    assert "l_extendedprice" not in text and "event_id" not in text


def test_segments_are_read_off_in_one_scan(plans):
    text = plans("customer_rfm")  # the stored history, and once more for the last purchase of all
    assert "hashpartitioning" not in text and "rangepartitioning" not in text
    assert text.count("FileScan") == 2 and "ReadSchema: struct<latest:timestamp_ntz>" in text


def test_outliers_are_filtered_in_one_scan_of_the_stored_orders(plans):
    text = plans("payment_outliers")
    assert "Exchange" not in text and text.count("FileScan") == 1 and "DataFilters: [isnotnull" in text


def test_sales_years_reach_the_fact_before_the_join(spark):
    tables = entry.Tables(spark, FOLDER)
    text = plan(orders_of_sales_years(tables.warehouse["fact_orders"], tables.warehouse["dim_date"], S))
    assert "19970101" in text and "19981231" in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", ["monthly_sales", "category_performance", "kpi_summary"])
def test_distinct_counts_copy_no_rows(plans, name):
    assert "Expand" not in plans(name)


def test_the_histogram_reads_counted_payments(plans):
    text = plans("payment_histogram")
    assert "l_extendedprice" not in text and "SortMergeJoin" not in text


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "category_performance", "delivery_by_state"])
def test_large_joins_are_shuffles_or_fixed_size_broadcasts(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_hot_order_is_split(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    staged = stage(marketplace_tables(spark, FOLDER))
    hot = F.when(F.col("order_item_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id"))
    items = staged["order_items"].withColumn("order_id", hot).repartition(8)
    skewed = staged.replacing(order_items=lambda: items)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        built = build_warehouse(skewed, spark, S)["fact_order_items"]
        built.collect()
        assert "skew=true" in plan(built)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
