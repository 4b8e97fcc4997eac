"""Order-item fact: one row per (order_id, order_item_id) with the keys of
its dimensions.

What depends on the order alone (customer version, its geography key, day,
primary payment and its junk key) is resolved on an order-level table, one row
an order, which is written once. The product and seller lookups come first, while
the items are narrow; then the items join their order once: this join is in
a stage of its own, so AQE can split an order that holds a large share of all
items. No side is broadcast by a hint:
AQE turns a join into a broadcast only after it has measured the side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.storage import if_small, materialize

c = F.col


def primary_payment(payments: DataFrame) -> DataFrame:
    """The largest payment of each order (ties: lowest payment_sequential).

    ``row_number() = 1`` lets Spark add a partial per-partition top-1 before
    the shuffle (WindowGroupLimit), so a hot order shuffles one row per map
    task, not all of its payments."""
    w = Window.partitionBy("order_id").orderBy(
        c("payment_value").desc_nulls_last(), c("payment_sequential").asc_nulls_last()
    )
    return (
        payments.withColumn("_rn", F.row_number().over(w))
        .filter(c("_rn") == 1)
        .select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
    )


def payment_lookup(dim_payment: DataFrame) -> DataFrame:
    """One key per (type, installments): MIN(payment_sk) per combination."""
    return dim_payment.groupBy("payment_type", "payment_installments").agg(F.min("payment_sk").alias("payment_sk"))


def payment_keys(payments: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """(order_id, payment_sk) of each order's primary payment; a NULL type or
    installment number never matches."""
    look = payment_lookup(dim_payment).select(
        c("payment_type").alias("_lt"), c("payment_installments").alias("_li"), "payment_sk"
    )
    return (
        primary_payment(payments)
        .join(look, (c("payment_type") == c("_lt")) & (c("payment_installments") == c("_li")), "left")
        .select("order_id", "payment_sk")
    )


def order_level(
    orders: DataFrame,
    payments: DataFrame,
    dim_customer: DataFrame,
    dim_geography: DataFrame,
    dim_date: DataFrame,
    dim_payment: DataFrame,
) -> DataFrame:
    """What each order gives its items. Inner: current customer, day. Left:
    geography of the current customer version, primary payment."""
    geo = dim_geography.select(c("geography_sk").alias("_geo_sk"), c("geography_sk").alias("geography_sk"))
    current = (
        dim_customer.filter(c("current_flag"))
        .select("customer_id", "customer_sk", c("geography_sk").alias("_cust_geo"))
        .join(geo, c("_cust_geo") == c("_geo_sk"), "left")
        .select("customer_id", "customer_sk", "geography_sk")
    )
    day = dim_date.select(c("calendar_date").alias("_day"), "date_sk")
    return (
        orders.select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("_day"))
        .join(current, "customer_id")
        .join(day, "_day")
        .join(payment_keys(payments, dim_payment), "order_id", "left")
        .select("order_id", "customer_id", "customer_sk", "geography_sk", "date_sk", "payment_sk")
    )


def build_fact_order_item(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_geography: DataFrame,
    dim_date: DataFrame,
    dim_payment: DataFrame,
) -> DataFrame:
    """Star lookup. Inner: order (with its customer and day), product, seller."""
    items = order_items.filter(c("order_id").isNotNull()).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )
    order_side = materialize(
        order_level(orders, payments, dim_customer, dim_geography, dim_date, dim_payment), "order-level"
    )
    f = (
        items.join(if_small(dim_product.select("product_id", "product_sk")), "product_id")
        .join(if_small(dim_seller.select("seller_id", "seller_sk")), "seller_id")
        .join(order_side, "order_id")
    )
    return f.select(
        "order_id",
        "order_item_id",
        "customer_sk",
        "product_sk",
        "seller_sk",
        "geography_sk",
        "date_sk",
        "payment_sk",
        "price",
        "freight_value",
        "customer_id",
    )
