"""Change-data-capture events.

Event record (one JSON object per line):
``entity_name, event_time, operation (insert/update/delete), primary_key,
payload (JSON object of the changed columns and their new values)`` plus
``event_id`` (unique per event) and ``arrival_seq`` (order of arrival).

``change_events`` derives such a stream from the driver's ``events`` table:
the event type picks the entity, ``props.k`` the new values, and
``arrival_seq`` scrambles arrival order so that many events arrive after
later ones (late data). A payload carries only the columns that changed; a
column may be set to an explicit null, which is not the same as absent. Some
events have no id, no or a malformed key, or an entity that no table has, as
feeds do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

c = F.col

CDC_SCHEMA = T.StructType(
    [
        T.StructField("entity_name", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("primary_key", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)

# Event type -> entity.
ENTITY_OF_EVENT = {
    "signup": "Customer",
    "view": "Customer",
    "click": "Product",
    "error": "Seller",
    "purchase": "OrderItem",
}

# Attributes each entity's payload may carry.
ENTITY_ATTRIBUTES = {
    "Customer": ["zip_code_prefix", "customer_city", "customer_state"],
    "Product": ["product_category_name", "product_weight_g"],
    "Seller": ["seller_city", "seller_state"],
    "OrderItem": ["price", "freight_value", "product_id", "seller_id"],
    "Order": ["order_status", "order_delivered_customer_date"],
    "Payment": ["payment_type", "payment_installments", "payment_value"],
}


def _entry(name: str, value: F.Column, present: F.Column | bool = True) -> F.Column:
    p = present if isinstance(present, F.Column) else F.lit(present)
    return F.struct(F.lit(name).alias("k"), value.cast("string").alias("v"), p.alias("p"))


def _payload(entries: list[F.Column]) -> F.Column:
    kept = F.filter(F.array(*entries), lambda e: e["p"])
    return F.to_json(F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"]))))


def change_events(events: DataFrame) -> DataFrame:
    events = events.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))  # read once, not in each value
    k = c("_k")
    s = lambda x: x.cast("string")
    i = c("event_id")
    entity = (
        F.when(i % 199 == 11, "Review")
        .when((c("event_type") == "view") & (i % 4 == 1), "Order")
        .when((c("event_type") == "click") & (i % 3 == 1), "Payment")
    )
    entity = F.coalesce(entity, *[F.when(c("event_type") == t, F.lit(e)) for t, e in ENTITY_OF_EVENT.items()])
    op = F.when(c("event_id") % 20 == 0, "delete").when(c("event_type") == "signup", "insert").otherwise("update")
    customer = _payload([
        _entry("zip_code_prefix", k % 25),
        _entry("customer_city", F.concat(F.lit("city_"), s(k % 25)), k % 2 == 0),
        _entry("customer_state", F.when(k % 10 != 3, F.concat(F.lit("S"), s(k % 5)))),
    ])
    product = _payload([
        _entry("product_category_name", F.concat(F.lit("CAT_"), s(k % 7)), k % 2 == 1),
        _entry("product_weight_g", k),
    ])
    seller = _payload([
        _entry("seller_city", F.concat(F.lit("city_"), s(k % 25))),
        _entry("seller_state", F.concat(F.lit("S"), s(k % 5)), k % 3 != 0),
    ])
    item = _payload([
        _entry("price", F.concat(s(k * 10), F.lit(".99"))),
        _entry("freight_value", F.concat(s(k), F.lit(".50"))),
        _entry("product_id", s(1 + k % 10), i % 2 == 0),
        _entry("seller_id", s(1 + k % 5), i % 2 == 0),
    ])
    order = _payload([
        _entry("order_status", F.when(k % 3 == 0, "delivered").when(k % 3 == 1, "shipped").otherwise("canceled")),
        _entry("order_delivered_customer_date", F.concat(s(F.to_date("ts")), F.lit("T00:00:00")), k % 3 == 0),
    ])
    payment = _payload([
        _entry("payment_type", F.concat(F.lit("P"), s(k % 4))),
        _entry("payment_installments", k % 12 + 1, k % 2 == 1),
        _entry("payment_value", F.concat(s(k * 100), F.lit(".00"))),
    ])
    payload = (
        F.when(op == "delete", F.lit("{}"))
        .when(entity == "Customer", customer)
        .when(entity == "Product", product)
        .when(entity == "Seller", seller)
        .when(entity == "Order", order)
        .when(entity == "Payment", payment)
        .otherwise(item)
    )
    pair = entity.isin("OrderItem", "Payment") & (i % 89 != 7)  # the others have a malformed key
    pk = F.when(pair, F.concat(s(c("user_id")), F.lit("|"), s(1 + i % 4))).otherwise(s(c("user_id")))
    pk = F.when(i % 211 != 3, pk)
    return events.select(
        entity.alias("entity_name"),
        c("ts").alias("event_time"),
        op.alias("operation"),
        pk.alias("primary_key"),
        payload.alias("payload"),
        F.when(i % 97 != 5, i).alias("event_id"),
        ((i * 7919) % 100003).alias("arrival_seq"),
    )
