from datetime import date, datetime
from decimal import Decimal

from tradewind.plans import warehouse as w


def test_dim_date_is_half_open(spark, calendar):
    days = calendar.orderBy("date").collect()
    assert len(days) == 791
    first, last = days[0], days[-1]
    assert first["date"] == date(2016, 9, 1) and last["date"] == date(2018, 10, 31)
    assert first.asDict() == {
        "date_key": 20160901, "date": date(2016, 9, 1), "year": 2016, "month": 9, "day": 1,
        "month_name": "September", "quarter": 3, "day_of_week": 4, "day_name": "Thursday", "is_weekend": False,
    }
    assert {d["day_name"] for d in days if d["is_weekend"]} == {"Saturday", "Sunday"}


def test_dim_customers_keeps_the_highest_customer_id(spark):
    customers = spark.createDataFrame(
        [("c1", "p1", "10", "Old", "SP"), ("c9", "p1", "20", None, "RJ"), ("c5", "p1", "10", "Mid", "SP"),
         ("c2", "p2", "99", "Far", "AM")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    geo = spark.createDataFrame(
        [("20", 1.0, 2.0), ("20", 2.0, 4.0), ("10", 9.0, 9.0)],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double",
    )
    found = {r["customer_key"]: r for r in w.dim_customers(customers, w.geo_zip_centroid(geo)).collect()}
    assert len(found) == 2
    person = found["p1"]
    assert (person["customer_id"], person["zip_code"], person["city"], person["state"]) == ("c9", "20", None, "RJ")
    assert (person["lat"], person["lng"]) == (1.5, 3.0)
    assert found["p2"]["lat"] is None  # a zip without a centroid


def test_dim_products_category_fallbacks(spark):
    products = spark.createDataFrame(
        [("a", "brinquedos", 10, 2, 3), ("b", "raro", 1, 1, 1), ("c", None, None, 2, 3)],
        "product_id string, product_category_name string, product_length_cm int, product_height_cm int, product_width_cm int",
    )
    for column in ("product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g"):
        from pyspark.sql import functions as F

        products = products.withColumn(column, F.lit(1))
    names = spark.createDataFrame(
        [("brinquedos", "toys")], "product_category_name string, product_category_name_english string"
    )
    found = {r["product_key"]: r for r in w.dim_products(products, names).collect()}
    assert {k: r["category"] for k, r in found.items()} == {"a": "toys", "b": "raro", "c": "unknown"}
    assert {k: r["volume_cm3"] for k, r in found.items()} == {"a": 60, "b": 1, "c": None}


def test_payment_agg(spark):
    payments = spark.createDataFrame(
        [("o1", "voucher", 1, 10.10), ("o1", "boleto", 3, 0.20), ("o1", "voucher", 2, 5.0), ("o2", None, None, None)],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    )
    found = {r["order_id"]: r for r in w.payment_agg(payments).collect()}
    assert (found["o1"]["total_payment"], found["o1"]["max_installments"], found["o1"]["payment_types"]) == (15.3, 3, "boleto,voucher")
    assert (found["o2"]["total_payment"], found["o2"]["payment_types"]) == (None, None)


def test_review_agg(spark):
    reviews = spark.createDataFrame(
        [("null", 1, None), ("empty", 2, ""), ("blank", 3, " "), ("text", 4, "x"),
         ("mixed", 1, None), ("mixed", 2, ""), ("mixed", 2, "ok"), ("half", 1, None), ("half", 2, None)],
        "order_id string, review_score int, review_comment_message string",
    )
    found = {r["order_id"]: r for r in w.review_agg(reviews).collect()}
    assert {k: r["has_review_comment"] for k, r in found.items()} == {
        "null": False, "empty": False, "blank": True, "text": True, "mixed": True, "half": False,
    }
    assert found["mixed"]["avg_review_score"] == Decimal("1.67")
    assert found["half"]["avg_review_score"] == Decimal("1.50")


ORDER_TEXT = """order_id string, customer_id string, order_status string, order_purchase_timestamp string,
    order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string,
    order_estimated_delivery_date string"""


def facts(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", "2018-01-31 23:59:59", "2018-02-01 00:00:00", "", "2018-02-05 00:00:01", "2018-02-10 23:00:00"),
         ("o2", "c2", "shipped", "2018-03-01 10:00:00", "", "", "", "2018-03-09 00:00:00"),
         ("o3", "nobody", "delivered", "2018-03-01 10:00:00", "", "", "", "")],
        ORDER_TEXT,
    )
    customers = spark.createDataFrame([("c1", "p1"), ("c2", "p2")], "customer_id string, customer_unique_id string")
    payments = spark.createDataFrame(
        [("o1", "boleto", 1, 30.0)],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    )
    reviews = spark.createDataFrame([("o1", 5, "x")], "order_id string, review_score int, review_comment_message string")
    return w.fact_orders(orders, customers, payments, reviews)


def test_fact_orders(spark):
    found = {r["order_id"]: r for r in facts(spark).collect()}
    assert set(found) == {"o1", "o2"}  # an order without customer is dropped
    o1, o2 = found["o1"], found["o2"]
    assert (o1["customer_key"], o1["purchase_date_key"], o1["delivery_delay_days"]) == ("p1", 20180131, -5)
    assert o1["purchased_at"] == datetime(2018, 1, 31, 23, 59, 59) and o1["shipped_at"] is None
    assert (o1["total_payment"], o1["has_review_comment"], o1["avg_review_score"]) == (30.0, True, Decimal("5.00"))
    assert (o2["delivered_at"], o2["delivery_delay_days"], o2["total_payment"]) == (None, None, 0.0)
    assert (o2["avg_review_score"], o2["has_review_comment"], o2["payment_types"]) == (None, False, None)


def test_fact_order_items(spark):
    items = spark.createDataFrame(
        [("o1", 1, "x", "s", 0.0, 0.0), ("o1", 2, "x", "s", 10.0, 0.0), ("o1", 3, "x", "s", 0.0, 4.0),
         ("o1", 4, "x", "s", 20.0, 10.0), ("gone", 1, "x", "s", 1.0, 1.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    found = {r["order_item_id"]: r for r in w.fact_order_items(items, facts(spark)).collect()}
    assert {k: r["freight_ratio"] for k, r in found.items()} == {1: None, 2: 0.0, 3: 1.0, 4: 0.3333}
    assert found[4]["total_item_value"] == 30.0 and found[4]["customer_key"] == "p1"
