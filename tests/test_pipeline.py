import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewind import Settings, run_pipeline
from tradewind.operators.quality import all_passed
from tradewind.operators.scratch import materialize, scratch_root, scratch_scope
from tradewind.sources.csv_load import CsvLoad
from tradewind.sources.raw import RAW_SCHEMAS, read_csv_folder, read_database, read_parquet_folder, stage
from tradewind.sources.retail import RETAIL_SETTINGS, marketplace_tables
from tradewind.operators.quality import RowCheck
from tradewind.plans.checks import WAREHOUSE_CHECKS, quality_report
from tradewind.plans.marts import monthly_sales, orders_of_sales_years
from tradewind.sources.sink import ensure_database, observations, row_counts, write_table

FOLDER = "/root/testdata/sf0.001"

CSV = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 11:00:00,2018-01-06 00:00:00,2018-01-09 12:00:00,2018-01-20 00:00:00
o2,c2,canceled,2018-02-05 10:00:00,,,,2018-02-20 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,x,s,2018-01-08 00:00:00,90.00,10.00
""",
    "payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,2,60.00
o1,2,voucher,1,40.00
""",
    "reviews": '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,4,,"first line
second, with ""quotes""",2018-01-10 00:00:00,2018-01-11 00:00:00
''',
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,p1,01001,sao paulo,SP
c2,p2,20000,rio,RJ
""",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,01001,sao paulo,SP\n",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
x,brinquedos,10,20,1,500,10,2,3
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01001,-23.5,-46.6,sao paulo,SP
""",
    "category_translation": "product_category_name,product_category_name_english\nbrinquedos,toys\n",
}


@pytest.fixture
def csv_folder(tmp_path):
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


@pytest.fixture
def databases(spark, tmp_path):
    names = [f"{kind}_{uuid.uuid4().hex[:8]}" for kind in ("warehouse", "marts")]
    for name in names:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield names
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_to_marts(spark, csv_folder, databases):
    built = run_pipeline(spark, read_csv_folder(spark, csv_folder), *databases)
    order = built.warehouse["fact_orders"].filter("order_id = 'o1'").first()
    assert (order["total_payment"], order["payment_types"], order["delivery_delay_days"]) == (100.0, "credit_card,voucher", -11)
    assert order["has_review_comment"] is True
    assert built.warehouse["dim_customers"].filter("customer_key = 'p1'").first()["zip_code"] == "01001"
    item = built.warehouse["fact_order_items"].first()
    assert (item["freight_ratio"], item["customer_key"]) == (0.1, "p1")
    assert built.marts["customer_rfm"].first()["monetary"] == 100.0
    assert built.marts["category_performance"].first()["category"] == "toys"
    assert all_passed(built.quality)
    assert {t.name for t in spark.catalog.listTables(databases[1]) if not t.isTemporary} == set(built.marts)
    assert dict((r["table_name"], r["n"]) for r in row_counts(built.warehouse).collect())["dim_date"] == 791


def test_csv_load_to_marts_counts_rejected_rows(spark, csv_folder, databases):
    with open(os.path.join(csv_folder, "payments.csv"), "a") as file:
        file.write("o1,xx,voucher,1,7.00\no1,3,voucher\n")
    built = run_pipeline(spark, CsvLoad(spark, csv_folder), *databases)
    assert built.warehouse["fact_orders"].filter("order_id = 'o1'").first()["total_payment"] == 100.0
    assert built.warehouse["fact_orders"].filter("order_id = 'o1'").first()["has_review_comment"] is True
    report = {r["check"]: (r["status"], r["violations"]) for r in built.quality.collect()}
    assert report["rejected_payments"] == ("FAIL", 2) and report["rejected_reviews"] == ("PASS", 0)
    assert len(report) == 17 + 9 and not all_passed(built.quality)
    with pytest.raises(ValueError, match="checks failed"):
        run_pipeline(spark, CsvLoad(spark, csv_folder), *databases, stop_on_failed_checks=True)


@pytest.mark.parametrize("buckets", [0, 3])
def test_row_checks_are_counted_while_the_facts_are_written(spark, databases, buckets):
    raw = marketplace_tables(spark, FOLDER)
    built = run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS, buckets=buckets)
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(built.quality) == rows(quality_report(built.warehouse)) and built.quality.count() == 17
    row_checks = {c.name for c in WAREHOUSE_CHECKS if isinstance(c, RowCheck)}
    known = observations(databases[0], "fact_orders", built.warehouse["fact_orders"])
    known |= observations(databases[0], "fact_order_items", built.warehouse["fact_order_items"])
    assert row_checks <= set(known)
    # What is known is not scanned for: no row check is left to be turned from a column into a row.
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (built.quality, quality_report(built.warehouse))]
    assert ["Expand" in plan for plan in plans] == [False, True]
    other = built.warehouse["fact_orders"].limit(5)
    assert observations(databases[0], "fact_orders", other) == {}


def test_facts_by_month_read_the_months_of_the_sales_years(spark, databases):
    raw = marketplace_tables(spark, FOLDER)
    built = run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS, by_month=True)
    orders = spark.table(f"{databases[0]}.fact_orders")
    assert spark.table(f"{databases[0]}.fact_order_items").columns[-1] == orders.columns[-1] == "purchase_month"
    sold = orders_of_sales_years(orders, built.warehouse["dim_date"], RETAIL_SETTINGS)
    months = {p for p in sold.select("month_start").distinct().toPandas()["month_start"].astype(str).str[:7]}
    assert len(months) == 24 == built.marts["monthly_sales"].count()
    plan = sold._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan and "199701" in plan and "199812" in plan
    plain = monthly_sales(orders.drop("purchase_month"), built.warehouse["dim_date"], RETAIL_SETTINGS)
    assert plain.collect() == built.marts["monthly_sales"].orderBy("month_start").collect()
    again = run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS)
    assert "purchase_month" not in again.warehouse["fact_orders"].columns


def test_csv_header_must_match(spark, csv_folder):
    (open(os.path.join(csv_folder, "sellers.csv"), "w")).write("seller_id,seller_state\ns,SP\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_folder(spark, csv_folder)["sellers"].collect()


def test_other_readers_agree_with_csv(spark, csv_folder, tmp_path, databases):
    raw = read_csv_folder(spark, csv_folder)
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / "parquet" / f"{name}.parquet"))
        write_table(df, databases[0], name)
    for other in (read_parquet_folder(spark, str(tmp_path / "parquet")), read_database(spark, databases[0])):
        assert set(other) == set(RAW_SCHEMAS)
        for name in raw:
            assert other[name].collect() == raw[name].collect(), name


def test_stage_renames_and_registers_views(spark, csv_folder):
    staged = stage(read_csv_folder(spark, csv_folder), views=True)
    assert {"order_payments", "order_reviews", "orders"} <= set(staged) and len(staged) == 9
    assert spark.table("staging_order_payments").count() == 2


def test_write_table_replaces(spark, databases):
    ensure_database(spark, databases[0])
    write_table(spark.range(5), databases[0], "t")
    assert write_table(spark.range(3).withColumn("p", F.col("id") % 2), databases[0], "t", partition_by=("p",)).count() == 3


def test_a_failed_write_changes_nothing(spark, databases):
    write_table(spark.range(5), databases[0], "t")
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_table(broken, databases[0], "t")
    assert sorted(r["id"] for r in spark.table(f"{databases[0]}.t").collect()) == [0, 1, 2, 3, 4]
    assert {t.name for t in spark.catalog.listTables(databases[0]) if not t.isTemporary} == {"t"}
    with pytest.raises(Exception, match="lost"):
        write_table(broken, databases[0], "new")
    assert not spark.catalog.tableExists(f"{databases[0]}.new")


@pytest.mark.parametrize("layout", [{}, {"bucket_by": "id", "buckets": 3}, {"partition_by": ("p",)}])
def test_a_table_is_rebuilt_from_itself_and_readers_keep_theirs(spark, databases, layout):
    rows = spark.range(6).withColumn("p", F.col("id") % 2)
    before = write_table(rows, databases[0], "t", **layout)
    again = write_table(spark.table(f"{databases[0]}.t").filter("id > 1").unionByName(spark.range(10, 12).withColumn("p", F.lit(7))), databases[0], "t", **layout)
    assert sorted(r["id"] for r in again.collect()) == [2, 3, 4, 5, 10, 11]
    assert before.count() == 6  # planned on the files of before
    wider = write_table(again.withColumn("q", F.lit("x")), databases[0], "t", **layout)
    assert set(wider.columns) == {"id", "p", "q"} and wider.count() == 6
    assert {t.name for t in spark.catalog.listTables(databases[0]) if not t.isTemporary} == {"t"}
    folder = spark.catalog.getDatabase(databases[0]).locationUri.removeprefix("file:") + "/versions.t"
    assert len(os.listdir(folder)) == 2


def test_pipeline_is_repeatable_and_buckets_spare_the_shuffle(spark, databases):
    raw = marketplace_tables(spark, FOLDER)
    first = run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS, buckets=4)
    counts = {name: df.count() for name, df in first.marts.items()}
    again = run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS, buckets=4)
    assert {name: df.count() for name, df in again.marts.items()} == counts
    assert counts["customer_rfm"] == 1108 and counts["monthly_sales"] == 24
    failed = {r["check"]: r["violations"] for r in again.quality.collect() if r["status"] == "FAIL"}
    assert failed == {"orders_date_fk": 122}
    orders, items = again.warehouse["fact_orders"], again.warehouse["fact_order_items"]
    # Read anew: the second build replaced the files.
    plan = items.select("order_id").join(orders.select("order_id").hint("merge"), "order_id")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_settings_default_to_the_marketplace():
    assert Settings().calendar_start == date(2016, 9, 1) and Settings().home_state == "SP"


def test_scratch_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or scratch_root(spark) == configured
    stored = materialize(spark.range(10).withColumn("x", F.lit("a")), "test")
    assert stored.count() == 10
    folder = scratch_root(spark).removeprefix("file:").lstrip("/")
    assert stored.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(folder + "/tradewind/test-")


def test_scratch_tables_go_with_their_scope(spark):
    with scratch_scope(spark):
        path = materialize(spark.range(3), "scoped").inputFiles()[0].removeprefix("file:").replace("///", "/")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_a_pipeline_run_leaves_no_scratch_tables(spark, databases):
    folder = scratch_root(spark).removeprefix("file:").replace("///", "/") + "/tradewind"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    run_pipeline(spark, marketplace_tables(spark, FOLDER), *databases, settings=RETAIL_SETTINGS, buckets=3)
    assert set(os.listdir(folder)) <= before


def test_buckets_are_one_file_each(spark, databases):
    ensure_database(spark, databases[0])
    stored = write_table(spark.range(1000).repartition(9), databases[0], "b", bucket_by="id", buckets=6)
    assert len(stored.inputFiles()) == 6 and stored.count() == 1000


def test_a_failed_check_can_stop_the_pipeline(spark, databases):
    raw = marketplace_tables(spark, FOLDER)
    with pytest.raises(ValueError, match="checks failed"):
        run_pipeline(spark, raw, *databases, settings=RETAIL_SETTINGS, stop_on_failed_checks=True)


@pytest.mark.parametrize("row", ["o1,abc,x,s,2018-01-08 00:00:00,90.00,10.00", "o1,1,x,s,2018-01-08 00:00:00,90.00"])
def test_a_bad_row_stops_the_load(spark, tmp_path, row):
    head = CSV["order_items"].split("\n")[0]
    (tmp_path / "order_items.csv").write_text(f"{head}\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_folder(spark, str(tmp_path))["order_items"].collect()
    lenient = read_csv_folder(spark, str(tmp_path), mode="PERMISSIVE")["order_items"]
    assert lenient.count() == 1
