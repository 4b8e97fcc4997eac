"""Wide reporting views at order-item grain.

Customer attributes are resolved *as of the order date*: equi-join on
customer_id plus ``order_date BETWEEN effective_date AND expiry_date``.
Spark plans it as a hash/sort-merge join on the key with the date range as a
residual; a key has few versions, so the residual is cheap, and AQE splits a
hot customer's partition (skew join). A customer with very many versions would make
that a product of items and versions: such customers' time is cut into spans, a
second join key (``many_versions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.storage import if_small, lacking, matching, materialize

c = F.col


def _base(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact + order day. No broadcast hint on the calendar: a sentinel date
    makes it long, and AQE broadcasts it where its measured size allows."""
    d = dim_date.select(
        c("date_sk").alias("_dsk"),
        c("calendar_date").alias("order_date"),
        c("year").alias("order_year"),
        c("month").alias("order_month"),
    )
    return fact.join(d, c("date_sk") == c("_dsk")).drop("_dsk").withColumn(
        "item_total", c("price") + c("freight_value")
    )


def customer_versions(dim_customer: DataFrame) -> DataFrame:
    """Versions as the as-of join needs them (join key renamed ``_cid``)."""
    return dim_customer.select(
        c("customer_id").alias("_cid"),
        "customer_unique_id",
        c("geography_sk").alias("_cust_geo"),
        c("customer_city").alias("customer_city_asof"),
        c("customer_state").alias("customer_state_asof"),
        "effective_date",
        "expiry_date",
    )


MANY_VERSIONS = 64


def many_versions(dim_customer: DataFrame, many: int = MANY_VERSIONS) -> DataFrame | None:
    """Customers with more than ``many`` versions, and how their time is cut: spans
    of ``_days`` days from ``_low`` to ``_high``, about as many as there are versions;
    what is earlier or later belongs to the first or last span. None if there is no
    such customer (the rule)."""
    dates = dim_customer.groupBy(c("customer_id").alias("_hid")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("expiry_date").alias("_low"), F.max("effective_date").alias("_high"))
    cut = dates.filter((c("_n") > many) & c("_hid").isNotNull()).select(
        "_hid", "_low", "_high", F.greatest(F.lit(1), F.ceil(F.datediff("_high", "_low") / c("_n"))).cast("int").alias("_days"))
    found = materialize(cut, "customers-with-many-versions")
    return None if found.isEmpty() else if_small(found)


def _span(day: str) -> Column:
    inside = F.least(F.greatest(c(day), c("_low")), c("_high"))
    return F.floor(F.datediff(inside, c("_low")) / c("_days")).cast("int")


def as_of(df: DataFrame, versions: DataFrame, day_col: str, many: DataFrame | None = None) -> DataFrame:
    """Attach the customer version valid on ``day_col`` (inner join).
    ``versions``: ``customer_versions(dim)``, possibly with more attributes.
    ``many``: ``many_versions(dim)``; a day lies in one span and a version is put
    into every span that it reaches, so each pair meets once."""
    cond = (c("customer_id") == c("_cid")) & c(day_col).between(c("effective_date"), c("expiry_date"))
    if many is None:
        return df.join(versions, cond).drop("_cid", "effective_date", "expiry_date")
    cut = ["_hid", "_low", "_high", "_days"]
    spans = F.when(c("_hid").isNotNull(), F.sequence(_span("effective_date"), F.greatest(_span("effective_date"), _span("expiry_date")))).otherwise(F.array(F.lit(0)))
    reach = versions.join(many, c("_cid") == c("_hid"), "left").withColumn("_reach", F.explode(spans)).drop(*cut)
    days = df.join(many, c("customer_id") == c("_hid"), "left").withColumn("_at", F.when(c("_hid").isNotNull(), _span(day_col)).otherwise(0)).drop(*cut)
    return days.join(reach, cond & (c("_at") == c("_reach"))).drop("_cid", "effective_date", "expiry_date", "_at", "_reach")


def first_order(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, many: DataFrame | None = None) -> DataFrame:
    """First order day per person (customer_unique_id), through the as-of
    join (orders without a valid version do not count).

    Items are first folded to distinct (customer_id, order day) pairs
    (map-side combine), so the as-of join sees one row per customer and day
    instead of one per item; the final min per person is a grouped
    aggregate whose partial step absorbs a hot person."""
    days = _base(fact, dim_date).select("customer_id", "order_date").distinct()
    asof = as_of(days, customer_versions(dim_customer), "order_date", many)
    return asof.groupBy("customer_unique_id").agg(F.min("order_date").alias("first_order_date"))


def sales_view(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_geography: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_payment: DataFrame,
) -> DataFrame:
    """28 columns per order item, customer attributes as of the order day,
    first-order date of the person and the new-customer flag.

    The version's geography and the person's first-order date depend only on
    the customer version, so they are joined onto the versions (dimension
    size) before the one as-of join, instead of onto every fact row."""
    geo = dim_geography.select(
        c("geography_sk").alias("_gsk"),
        c("zip_code_prefix").alias("customer_zip_asof"),
        c("latitude").alias("customer_lat_asof"),
        c("longitude").alias("customer_lng_asof"),
    )
    many = many_versions(dim_customer)
    fco = first_order(fact, dim_date, dim_customer, many).withColumnRenamed("customer_unique_id", "_fuid")
    versions = (
        customer_versions(dim_customer)
        .join(geo, c("_cust_geo") == c("_gsk"), "left")
        .join(fco, c("customer_unique_id") == c("_fuid"), "left")
        .drop("_gsk", "_fuid", "_cust_geo")
    )
    prod = dim_product.select(
        c("product_sk").alias("_psk"),
        "product_id",
        c("product_category_name").alias("product_category_pt"),
        c("product_name_english").alias("product_category_en"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    sell = dim_seller.select(c("seller_sk").alias("_ssk"), "seller_id", "seller_city", "seller_state")
    prod, sell = if_small(prod), if_small(sell)
    pay = dim_payment.select(c("payment_sk").alias("_pay"), "payment_type", "payment_installments")
    # payments, which may be as many as the orders, while the items are narrow; customers
    # last: a person's orders then lie in one task, and store small
    items = _base(fact, dim_date).join(pay, c("payment_sk") == c("_pay"), "left")
    items = items.join(prod, c("product_sk") == c("_psk")).join(sell, c("seller_sk") == c("_ssk"))
    v = as_of(items, versions, "order_date", many)
    return v.select(
        "order_id",
        "order_item_id",
        "order_date",
        "order_year",
        "order_month",
        "price",
        "freight_value",
        "item_total",
        "product_id",
        "product_category_pt",
        "product_category_en",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "seller_id",
        "seller_city",
        "seller_state",
        "customer_unique_id",
        "customer_city_asof",
        "customer_state_asof",
        "customer_zip_asof",
        "customer_lat_asof",
        "customer_lng_asof",
        "payment_type",
        "payment_installments",
        "first_order_date",
        F.coalesce(c("order_date") == c("first_order_date"), F.lit(False)).alias("new_customer_flag"),
    )


#: What a view's rows hold of their product and seller: column -> column of the dimension.
OF_PRODUCT = {
    "product_category_pt": "product_category_name", "product_category_en": "product_name_english", "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm", "product_height_cm": "product_height_cm", "product_width_cm": "product_width_cm",
}
OF_SELLER = {"seller_city": "seller_city", "seller_state": "seller_state"}


def what_changed(dim: DataFrame, key: str, named: DataFrame, columns: dict[str, str]) -> DataFrame:
    """For each of the ``named`` keys (``_key``, distinct, none null): whether a ``_live``
    row of ``dim`` has it (at most one does), and what that row has for the
    ``columns`` of a view."""
    rows = dim.select(c(key).alias("_k"), F.lit(True).alias("_live"), *[c(x).alias(f"_{v}") for v, x in columns.items()])
    return named.join(rows, c("_key") == c("_k"), "left").drop("_k")


def renewed(view: DataFrame, key: str, changed: DataFrame, gone: str) -> DataFrame:
    """A view's rows with what they hold of their product or seller (``key``) as
    ``changed`` (of ``what_changed``; ``storage.if_small`` of it, so that no row is
    shuffled) has it, and in the column ``gone`` whether that one is no longer there.
    Rows of others are as they were."""
    columns = [x for x in view.columns if f"_{x}" in changed.columns]
    named = changed.select("_key", "_live", *[f"_{x}" for x in columns])
    hit = c("_key").isNotNull()
    out = {x: F.when(hit, c(f"_{x}")).otherwise(c(x)) for x in columns}
    out[gone] = F.when(hit, c("_live").isNull()).otherwise(c(gone) if gone in view.columns else F.lit(False))
    return view.join(named, c(key) == c("_key"), "left").withColumns(out).drop(*named.columns)


def orders_to_refresh(
    touched: DataFrame, facts: list[DataFrame], dim_customer: DataFrame, customers: DataFrame | None = None,
    products: DataFrame | None = None, sellers: DataFrame | None = None,
) -> DataFrame:
    """All orders whose sales rows may change: the touched ones (order_id), those
    of touched customers (customer_id), with items of touched products (product_sk)
    or sellers (seller_sk), before or after the change (``facts``: items, or the orders
    and customers of items if no product or seller is given), and, as a
    person's first order day is on each of their rows, all orders of the same
    persons."""
    changes = [("customer_id", customers), ("product_sk", products), ("seller_sk", sellers)]
    keys = list(dict.fromkeys(["order_id", "customer_id", *[key for key, changed in changes if changed is not None]]))
    rows = facts[0].select(*keys)
    for f in facts[1:]:
        rows = rows.unionByName(f.select(*keys))
    hit = rows.join(touched.select("order_id"), "order_id", "left_semi")
    for key, changed in changes:
        if changed is not None:
            hit = hit.unionByName(rows.join(changed.select(key), key, "left_semi").select(*keys))
    person = dim_customer.select("customer_id", "customer_unique_id").distinct()
    persons = person.join(hit.select("customer_id").distinct(), "customer_id", "left_semi").select("customer_unique_id").distinct()
    mates = person.join(persons, "customer_unique_id", "left_semi").select("customer_id").distinct()
    theirs = rows.join(mates, "customer_id", "left_semi").select("order_id")
    return touched.select("order_id").unionByName(hit.select("order_id")).unionByName(theirs).distinct()


def refresh_sales_view(sales: DataFrame, orders: DataFrame, fact: DataFrame, *dimensions: DataFrame) -> DataFrame:
    """The sales view after a change of some ``orders`` (closed as by
    ``orders_to_refresh``): their rows are made anew from the fact and the
    dimensions (as ``sales_view`` takes them), the others are kept."""
    new = sales_view(matching(fact, orders, "order_id"), *dimensions)
    return lacking(sales, orders, "order_id").unionByName(new)


def fulfillment_view(
    fact: DataFrame,
    orders: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_customer: DataFrame,
) -> DataFrame:
    """25 columns per order item: lifecycle timestamps, day counts, product,
    seller and the customer's city/state as of the order day.

    What an item has of its order, its customer and its day is looked up once for
    each such triple, and joined to the items in one go."""
    d = dim_date.select(c("date_sk").alias("_dsk"), c("calendar_date").alias("order_date"))
    o = orders.select(
        c("order_id").alias("_oid"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "order_status",
    )
    prod = dim_product.select(
        c("product_sk").alias("_psk"),
        "product_id",
        c("product_category_name").alias("product_category_pt"),
        c("product_name_english").alias("product_category_en"),
    )
    sell = dim_seller.select(c("seller_sk").alias("_ssk"), "seller_id", "seller_city", "seller_state")
    prod, sell = if_small(prod), if_small(sell)
    triple = ["order_id", "customer_id", "date_sk"]
    level = fact.select(*triple).distinct().join(o, c("order_id") == c("_oid")).join(d, c("date_sk") == c("_dsk")).drop("_oid", "_dsk")
    level = as_of(level, customer_versions(dim_customer).drop("_cust_geo"), "order_date", many_versions(dim_customer))
    items = fact.select(*triple, "order_item_id", "product_sk", "seller_sk", "price", "freight_value")
    items = items.join(prod, c("product_sk") == c("_psk")).join(sell, c("seller_sk") == c("_ssk"))
    return items.join(level, triple).select(
        "order_id",
        "order_item_id",
        "order_date",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "order_status",
        F.datediff("order_approved_at", "order_purchase_timestamp").alias("days_to_approve"),
        F.datediff("order_delivered_carrier_date", "order_approved_at").alias("days_to_ship"),
        F.datediff("order_delivered_customer_date", "order_purchase_timestamp").alias("days_to_deliver"),
        F.datediff("order_delivered_customer_date", "order_estimated_delivery_date").alias("days_vs_estimated"),
        "price",
        "freight_value",
        (c("price") + c("freight_value")).alias("item_total"),
        "product_id",
        "product_category_pt",
        "product_category_en",
        "seller_id",
        "seller_city",
        "seller_state",
        "customer_unique_id",
        "customer_city_asof",
        "customer_state_asof",
    )


def refresh_fulfillment_view(fulfillment: DataFrame, orders_touched: DataFrame, fact: DataFrame, orders: DataFrame, *dimensions: DataFrame) -> DataFrame:
    """The fulfilment view after a change of some orders (closed as by
    ``orders_to_refresh``): their rows are made anew from the fact, the orders and
    the dimensions (as ``fulfillment_view`` takes them), the others are kept."""
    mine = lambda df: matching(df, orders_touched, "order_id")
    new = fulfillment_view(mine(fact), mine(orders), *dimensions)
    return lacking(fulfillment, orders_touched, "order_id").unionByName(new)
