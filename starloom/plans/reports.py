"""Business reports on the wide views (grouped aggregates + order/limit).

Money stays decimal through the aggregation and is returned as DOUBLE;
means are ``sum / count`` in DOUBLE. Every ORDER BY is completed with the
group keys so LIMIT and ties give one fixed answer.

Reports that count distinct orders next to other aggregates aggregate in
two levels: per (group, order) first, then per group, where the number of
rows is the distinct order count. That is exact for sums, counts, min/max
and sum/count means, and avoids Spark's distinct rewrite (Expand doubles
the rows it shuffles and gives every (group, order) its own buffer for
every other aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def money(col: str | Column) -> Column:
    return F.sum(col).cast("double")


def mean(col: str | Column) -> Column:
    x = c(col) if isinstance(col, str) else col
    return F.sum(x).cast("double") / F.count(x)


def _asc(*cols: str) -> list[Column]:
    return [c(x).asc_nulls_first() for x in cols]


def _per_order(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Level 1: one row per (keys, order_id) with sum/count of ``value`` and
    the item count."""
    return df.groupBy(*keys, "order_id").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_cnt"), F.count(F.lit(1)).alias("_items")
    )


def _mean2(sum_col: str = "_sum", cnt_col: str = "_cnt") -> Column:
    return F.sum(sum_col).cast("double") / F.nullif(F.sum(cnt_col), F.lit(0))


def _sales_orders_items(sales: DataFrame, keys: list[str], sales_name: str) -> DataFrame:
    return _per_order(sales, keys, "item_total").groupBy(*keys).agg(
        money("_sum").alias(sales_name),
        F.count(F.lit(1)).alias("num_orders"),
        F.sum("_items").alias("num_items"),
    )


def q_daily_sales(sales: DataFrame) -> DataFrame:
    return _sales_orders_items(sales, ["order_date"], "total_sales").orderBy(*_asc("order_date"))


def q_monthly_sales(sales: DataFrame) -> DataFrame:
    return _sales_orders_items(sales, ["order_year", "order_month"], "total_sales").orderBy(
        *_asc("order_year", "order_month")
    )


def q_revenue_by_category(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("product_category_en")
        .agg(money("item_total").alias("category_sales"), F.count(F.lit(1)).alias("items_sold"))
        .orderBy(c("category_sales").desc_nulls_last(), *_asc("product_category_en"))
    )


def q_revenue_by_seller(sales: DataFrame) -> DataFrame:
    keys = ["seller_id", "seller_city", "seller_state"]
    return (
        _per_order(sales, keys, "item_total")
        .groupBy(*keys)
        .agg(money("_sum").alias("seller_sales"), F.count(F.lit(1)).alias("num_orders"))
        .orderBy(c("seller_sales").desc_nulls_last(), *_asc(*keys))
    )


def _top(sales: DataFrame, keys: list[str], k: int) -> DataFrame:
    return (
        sales.groupBy(*keys)
        .agg(money("item_total").alias("combo_sales"), F.count(F.lit(1)).alias("items_sold"))
        .orderBy(c("combo_sales").desc_nulls_last(), *_asc(*keys))
        .limit(k)
    )


def q_top_category_state(sales: DataFrame, k: int = 20) -> DataFrame:
    return _top(sales, ["product_category_en", "customer_state_asof"], k)


def q_top_seller_category(sales: DataFrame, k: int = 20) -> DataFrame:
    return _top(sales, ["seller_id", "product_category_en"], k)


def q_new_customers(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(c("new_customer_flag"))
        .groupBy("order_year", "order_month")
        .agg(F.countDistinct("customer_unique_id").alias("new_customers"))
        .orderBy(*_asc("order_year", "order_month"))
    )


def q_basket_by_state(sales: DataFrame) -> DataFrame:
    """Two-level aggregate: order totals, then state averages."""
    orders = sales.groupBy("order_id", "customer_state_asof").agg(
        F.sum("item_total").alias("order_total"), F.count(F.lit(1)).alias("num_items")
    )
    return (
        orders.groupBy("customer_state_asof")
        .agg(
            mean("order_total").alias("avg_order_value"),
            mean("num_items").alias("avg_items_per_order"),
            # rows are unique per (order_id, state): count(*) = distinct orders
            F.count(F.lit(1)).alias("orders"),
        )
        .orderBy(c("avg_order_value").desc_nulls_last(), *_asc("customer_state_asof"))
    )


def q_spend_by_version(sales: DataFrame) -> DataFrame:
    keys = ["customer_unique_id", "customer_city_asof", "customer_state_asof"]
    per_order = sales.groupBy(*keys, "order_id").agg(
        F.min("order_date").alias("_first"), F.max("order_date").alias("_last"), F.sum("item_total").alias("_sum")
    )
    return (
        per_order.groupBy(*keys)
        .agg(
            F.min("_first").alias("first_order_in_version"),
            F.max("_last").alias("last_order_in_version"),
            money("_sum").alias("sales_in_version"),
            F.count(F.lit(1)).alias("orders_in_version"),
        )
        .orderBy(*_asc("customer_unique_id", "first_order_in_version", "customer_city_asof", "customer_state_asof"))
    )


def q_revenue_by_seller_state(sales: DataFrame) -> DataFrame:
    """One scan: a fold per (state, seller, order), and the sales sum, distinct
    orders and distinct sellers per state from it."""
    key = "seller_state"
    fold = sales.groupBy(key, "seller_id", "order_id").agg(F.sum("item_total").alias("_sum"))
    return (
        fold.groupBy(key)
        .agg(
            money("_sum").alias("seller_state_sales"),
            F.countDistinct("order_id").alias("num_orders"),
            F.countDistinct("seller_id").alias("num_sellers"),
        )
        .orderBy(c("seller_state_sales").desc_nulls_last(), *_asc(key))
    )


def q_payment_mix(sales: DataFrame) -> DataFrame:
    keys = ["payment_type", "payment_installments"]
    return (
        _per_order(sales, keys, "item_total")
        .groupBy(*keys)
        .agg(
            money("_sum").alias("payment_sales"),
            F.sum("_items").alias("num_items"),
            F.count(F.lit(1)).alias("num_orders"),
        )
        .orderBy(c("payment_sales").desc_nulls_last(), *_asc("payment_type", "payment_installments"))
    )


def _delivered(ful: DataFrame) -> DataFrame:
    return ful.filter(c("order_status") == "delivered")


def _delivery(ful: DataFrame, keys: list[str]) -> DataFrame:
    return (
        _per_order(_delivered(ful), keys, "days_to_deliver")
        .groupBy(*keys)
        .agg(_mean2().alias("avg_days_to_deliver"), F.count(F.lit(1)).alias("orders"))
    )


def q_delivery_by_state(ful: DataFrame) -> DataFrame:
    return _delivery(ful, ["customer_state_asof"]).orderBy(
        c("avg_days_to_deliver").desc_nulls_last(), *_asc("customer_state_asof")
    )


def q_delivery_by_category(ful: DataFrame) -> DataFrame:
    """The p90 needs item values, so it is its own per-item aggregate; the two
    small per-category results are joined on the (nullable) category."""
    key = "product_category_en"
    p90 = (
        _delivered(ful)
        .groupBy(key)
        .agg(F.percentile_approx("days_to_deliver", 0.9).alias("p90_days_to_deliver"))
        .withColumnRenamed(key, "_k")
    )
    out = _delivery(ful, [key]).join(p90, c(key).eqNullSafe(c("_k"))).drop("_k")
    return out.select(key, "avg_days_to_deliver", "p90_days_to_deliver", "orders").orderBy(
        c("avg_days_to_deliver").desc_nulls_last(), *_asc(key)
    )


def q_seller_speed(ful: DataFrame, min_orders: int = 20) -> DataFrame:
    return (
        _delivery(ful, ["seller_id", "seller_state"])
        .filter(c("orders") >= min_orders)
        .orderBy(c("avg_days_to_deliver").asc_nulls_first(), *_asc("seller_id", "seller_state"))
    )


def q_late_rate(ful: DataFrame) -> DataFrame:
    late = F.when(c("days_vs_estimated") > 0, 1).otherwise(0)
    return (
        _delivered(ful)
        .groupBy("customer_state_asof", "product_category_en")
        .agg(F.count(F.lit(1)).alias("items"), mean(late).alias("late_delivery_rate"))
        .orderBy(c("late_delivery_rate").desc_nulls_last(), *_asc("customer_state_asof", "product_category_en"))
    )
