from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as dictionaries, in a stable order."""
    return lambda df: sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


ORDER_SCHEMA = """order_id string, customer_key string, purchase_date_key int, order_status string,
    purchased_at timestamp_ntz, delivered_at timestamp_ntz, delivery_delay_days int,
    total_payment double, avg_review_score decimal(3,2)"""
ITEM_SCHEMA = """order_id string, order_item_id int, product_key string, seller_key string,
    price double, freight_value double, freight_ratio double, avg_review_score decimal(3,2),
    delivery_delay_days int, order_status string"""
CUSTOMER_SCHEMA = "customer_key string, city string, state string, lat double, lng double"


@pytest.fixture
def fact_orders(spark):
    """Order facts from (id, customer, status, purchased, delay, payment, score) tuples."""

    def build(*tuples):
        from decimal import Decimal

        full = []
        for order_id, customer, status, purchased, delay, payment, score in tuples:
            when = datetime.fromisoformat(purchased)
            key = when.year * 10000 + when.month * 100 + when.day
            delivered = when if delay is not None else None
            score = None if score is None else Decimal(score)
            full.append((order_id, customer, key, status, when, delivered, delay, payment, score))
        return spark.createDataFrame(full, ORDER_SCHEMA)

    return build


@pytest.fixture
def customers(spark):
    def build(**states):
        return spark.createDataFrame([(k, None, s, None, None) for k, s in states.items()], CUSTOMER_SCHEMA)

    return build


@pytest.fixture
def calendar(spark):
    from tradewind.plans.warehouse import dim_date

    return dim_date(spark, date(2016, 9, 1), date(2018, 11, 1))
