"""Report semantics on hand-made views."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.plans import reports as R

D = dt.date


def sales(spark, rows):
    """rows: (order_id, uid, city, state, date, total, seller, category)."""
    df = spark.createDataFrame(
        rows, "order_id string, customer_unique_id string, customer_city_asof string, customer_state_asof string, "
              "order_date date, item_total decimal(19,2), seller_id string, product_category_en string"
    )
    return df.withColumn("order_year", F.year("order_date")).withColumn("order_month", F.month("order_date"))


def test_spend_by_version_two_cities_two_rows(spark):
    s = sales(spark, [
        ("o1", "p", "city_a", "SP", D(2017, 1, 5), Decimal("10.00"), "s", "x"),
        ("o1", "p", "city_a", "SP", D(2017, 1, 5), Decimal("5.00"), "s", "x"),
        ("o2", "p", "city_b", "RJ", D(2018, 3, 1), Decimal("7.50"), "s", "x"),
    ])
    got = [tuple(r) for r in R.q_spend_by_version(s).collect()]
    assert got == [
        ("p", "city_a", "SP", D(2017, 1, 5), D(2017, 1, 5), 15.0, 1),
        ("p", "city_b", "RJ", D(2018, 3, 1), D(2018, 3, 1), 7.5, 1),
    ]


def test_top_k_ties_broken_by_keys(spark):
    rows = [(f"o{i}", "p", "c", "S", D(2017, 1, 1), Decimal("1.00"), "s", f"cat{i:02d}") for i in range(25)]
    got = R.q_top_category_state(sales(spark, rows)).collect()
    assert len(got) == 20
    assert [r.product_category_en for r in got] == [f"cat{i:02d}" for i in range(20)]


def test_daily_sales_counts_distinct_orders(spark):
    s = sales(spark, [
        ("o1", "p", "c", "S", D(2017, 1, 1), Decimal("1.10"), "s", "x"),
        ("o1", "p", "c", "S", D(2017, 1, 1), Decimal("2.20"), "s", "x"),
        ("o2", "q", "c", "S", D(2017, 1, 1), Decimal("3.30"), "s", "x"),
    ])
    assert [tuple(r) for r in R.q_daily_sales(s).collect()] == [(D(2017, 1, 1), 6.6, 2, 3)]


def test_seller_speed_threshold(spark):
    ful = spark.createDataFrame(
        [(f"o{i}", "s1" if i < 3 else "s2", "SP", "delivered", i) for i in range(5)],
        "order_id string, seller_id string, seller_state string, order_status string, days_to_deliver int",
    )
    assert [r.seller_id for r in R.q_seller_speed(ful, min_orders=3).collect()] == ["s1"]
    assert [r.seller_id for r in R.q_seller_speed(ful, min_orders=2).collect()] == ["s1", "s2"]


def test_late_rate_counts_null_delivery_as_on_time(spark):
    ful = spark.createDataFrame(
        [("o1", "S", "c", "delivered", 2), ("o2", "S", "c", "delivered", None), ("o3", "S", "c", "shipped", 9)],
        "order_id string, customer_state_asof string, product_category_en string, order_status string, "
        "days_vs_estimated int",
    )
    assert [tuple(r) for r in R.q_late_rate(ful).collect()] == [("S", "c", 2, 0.5)]
