"""Conformed dimensions: geography, customer (initial SCD2 load), product,
seller, payment (junk), calendar.

Surrogate keys are dense and ordered by the natural key (see
``functions.keys``). Passing the previous version of a dimension
(``previous=``) keeps every known natural key's surrogate key and numbers
only new keys after the largest, so facts keyed on an older build stay valid.
Zip codes are joined through ``try_cast``: ANSI casts raise on bad input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import keep_keys

OPEN_START = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)

c = F.col


def zip_key(col: str) -> F.Column:
    return F.expr(f"try_cast({col} AS INT)")


def build_dim_geography(geolocation: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row per *integer* zip: the raw zip spellings ('01234', '1234') of
    one number fold into one row, so a zip lookup never multiplies rows.
    City/state take the smallest value (a fixed choice instead of FIRST)."""
    g = geolocation.groupBy(zip_key("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
        (F.sum("geolocation_lat") / F.count("geolocation_lat")).alias("latitude"),
        (F.sum("geolocation_lng") / F.count("geolocation_lng")).alias("longitude"),
    )
    return keep_keys(g, ["zip_code_prefix"], "geography_sk", previous)


def geography_lookup(dim_geography: DataFrame) -> DataFrame:
    return dim_geography.select(c("zip_code_prefix").alias("_zip"), "geography_sk")


def with_geography(df: DataFrame, zip_col: str, dim_geography: DataFrame) -> DataFrame:
    """LEFT JOIN on the integer zip; unmatched or uncastable zips get NULL."""
    return df.join(
        geography_lookup(dim_geography), zip_key(zip_col) == c("_zip"), "left"
    ).drop("_zip")


def stage_customers(customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """customers LEFT JOIN geography -> (id, unique id, geography_sk, city, state)."""
    return with_geography(customers, "customer_zip_code_prefix", dim_geography).select(
        "customer_id", "customer_unique_id", "geography_sk", "customer_city", "customer_state"
    )


def build_dim_customer_initial(
    customers: DataFrame, dim_geography: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    """First version of every customer, valid 1900-01-01 .. 9999-12-31."""
    staged = stage_customers(customers, dim_geography).select(
        "*",
        F.lit(OPEN_START).alias("effective_date"),
        F.lit(OPEN_END).alias("expiry_date"),
        F.lit(True).alias("current_flag"),
    )
    return keep_keys(staged, ["customer_id", "effective_date"], "customer_sk", previous)


def build_dim_product(products: DataFrame, translation: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Products with an id, English category name by LEFT JOIN.
    The translation table holds one row per category (a lookup, tiny by
    nature); Spark broadcasts it when its measured size allows."""
    t = translation.select(
        c("product_category_name").alias("_cat"), c("product_category_name_english").alias("product_name_english")
    )
    p = products.filter(c("product_id").isNotNull()).join(t, c("product_category_name") == c("_cat"), "left")
    p = p.select(
        "product_id",
        "product_category_name",
        "product_name_english",
        c("product_name_lenght").alias("product_name_length"),
        c("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    return keep_keys(p, ["product_id"], "product_sk", previous)


def build_dim_payment(payments: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Junk dimension: distinct (type, installments), NULL combination kept."""
    d = payments.select("payment_type", "payment_installments").distinct()
    return keep_keys(d, ["payment_type", "payment_installments"], "payment_sk", previous)


def build_dim_seller(sellers: DataFrame, dim_geography: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    s = with_geography(sellers, "seller_zip_code_prefix", dim_geography).select(
        "seller_id", "geography_sk", "seller_city", "seller_state"
    )
    return keep_keys(s, ["seller_id"], "seller_sk", previous)


def build_dim_date(orders: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Gap-free calendar from the first to the last purchase day.

    One global min/max, then ``explode(sequence)``: the output has one row
    per calendar day (bounded by the date span, not by the data volume).
    ``date_sk`` is the day number from the first day, which is exactly
    ``ROW_NUMBER() OVER (ORDER BY d)`` on a gap-free calendar, without the
    single-partition window. With the previous calendar the numbering goes on
    from its first day, so every day keeps its key (an earlier day than that
    one gets a key below 1)."""
    days = orders.select(F.to_date("order_purchase_timestamp").alias("d"), F.lit(None).cast("date").alias("day_one"))
    if previous is not None:
        days = days.unionByName(
            previous.select(c("calendar_date").alias("d"), F.date_sub("calendar_date", (c("date_sk") - 1).cast("int")).alias("day_one"))
        )
    bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min("day_one").alias("first"))
    bounds = bounds.withColumn("first", F.coalesce("first", "lo"))
    cal = bounds.select("first", F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return cal.select(
        (F.datediff("d", "first") + 1).cast("bigint").alias("date_sk"),
        c("d").alias("calendar_date"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"),
        F.dayofweek("d").alias("day_of_week"),
        F.weekofyear("d").alias("week_of_year"),
    )


ROLE_COLUMNS = {
    "purchase": "order_purchase_timestamp",
    "approved": "order_approved_at",
    "carrier": "order_delivered_carrier_date",
    "delivered": "order_delivered_customer_date",
    "estimated": "order_estimated_delivery_date",
}


def dim_date_roles(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The calendar joined once per date role of an order (role-playing
    dimension), plus the purchase quarter. The calendar is small unless a
    sentinel date stretches it, so AQE decides how each lookup joins."""
    out = orders.select("order_id", *ROLE_COLUMNS.values())
    for role, col in ROLE_COLUMNS.items():
        lookup = dim_date.select(c("calendar_date").alias(f"_d_{role}"), c("date_sk").alias(f"{role}_date_sk"))
        out = out.join(lookup, F.to_date(col) == c(f"_d_{role}"), "left").drop(f"_d_{role}")
    return out.select(
        "order_id",
        *[f"{r}_date_sk" for r in ROLE_COLUMNS],
        F.quarter("order_purchase_timestamp").alias("purchase_quarter"),
    )
