"""SQL users: the model as temp views, questions as plain Spark SQL."""

from conftest import SF_SMALL
from starloom.plans import reports as R
from starloom.plans.warehouse import register_views, warehouse


def test_views_answer_sql(spark):
    w = warehouse(spark, SF_SMALL)
    assert {"wh_sales_items", "wh_delivery_items", "wh_dim_customer"} <= set(register_views(w, prefix="wh_"))
    busiest = spark.sql(
        "SELECT order_date, round(sum(item_total), 2) AS amount FROM wh_sales_items GROUP BY ALL ORDER BY amount DESC LIMIT 3"
    ).collect()
    daily = {r.order_date: round(float(r.total_sales), 2) for r in R.q_daily_sales(w.sales).collect()}
    assert [float(r.amount) for r in busiest] == sorted(daily.values(), reverse=True)[:3]
    late = spark.sql("SELECT count_if(days_vs_estimated > 0) AS late, count(*) AS n FROM wh_delivery_items WHERE order_status = 'delivered'").first()
    rates = R.q_late_rate(w.fulfillment).collect()
    assert late.n == sum(r["items"] for r in rates)
    assert late.late == round(sum(r["items"] * r.late_delivery_rate for r in rates))


def test_every_sale_has_one_version(spark):
    w = warehouse(spark, SF_SMALL)
    register_views(w, prefix="wh_")
    n = spark.sql("""
        WITH days AS (SELECT date_sk, calendar_date AS day FROM wh_dim_date),
             spans AS (SELECT customer_id, effective_date AS a, expiry_date AS b FROM wh_dim_customer)
        SELECT count(*) FROM wh_fact_order_item NATURAL JOIN days NATURAL JOIN spans WHERE day >= a AND day <= b""").first()[0]
    assert n == w.sales.count()
