"""The applier's views follow their products and sellers without being made anew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import OPEN
from starloom.functions import publish, storage
from starloom.operators import fact, scd2
from starloom.plans import views
from starloom.sources.cdc_events import CDC_SCHEMA
from starloom.streaming import gold

D = dt.date


def tiny(spark, root, orders=6):
    """Orders of two items each, three products, two sellers, a customer an order."""
    make = spark.createDataFrame
    geo = make([(1, 10, 1.0, 2.0)], "geography_sk long, zip_code_prefix int, latitude double, longitude double")
    days = make([(1, D(2024, 1, 1), 2024, 1), (2, D(2024, 1, 2), 2024, 1)], "date_sk long, calendar_date date, year int, month int")
    log = make([(f"c{i}", f"u{i // 2}", 1, "city", "S1", OPEN, 0) for i in range(orders)],
               "customer_id string, customer_unique_id string, geography_sk long, customer_city string, customer_state string, obs_date date, obs_rank int")
    customers = scd2.timeline(log).withColumn("customer_sk", F.expr("cast(substring(customer_id, 2) as long)"))
    names = "product_sk long, product_id string, product_category_name string, product_name_english string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"
    products = make([(k, f"p{k}", "cat", "en", k, 1, 2, 3) for k in range(3)], names)
    sellers = make([(k, f"s{k}", "town", "ST") for k in range(2)], "seller_sk long, seller_id string, seller_city string, seller_state string")
    t = dt.datetime(2024, 1, 1)
    bought = make([(f"o{i}", f"c{i}", "shipped", t, t, t, t, t) for i in range(orders)],
                  "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                  "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    payments = make([(f"o{i}", 1, "card", 1 + i % 2, 5) for i in range(orders)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value int")
    payments = payments.withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)"))
    keys = make([(f"o{i}", f"c{i}", i, 1, 1 + i % 2, 1 + i % 2) for i in range(orders)], "order_id string, customer_id string, customer_sk long, geography_sk long, date_sk long, payment_sk long")
    items = make([(f"o{i}", n, (i + n) % 3, (i + n) % 2) for i in range(orders) for n in (1, 2)], "order_id string, order_item_id int, product_sk long, seller_sk long")
    items = items.join(keys, "order_id").withColumns({"price": F.lit(10).cast("decimal(18,2)"), "freight_value": F.lit(1).cast("decimal(18,2)")})
    paid = make([(1, "card", 1), (2, "card", 2)], "payment_sk long, payment_type string, payment_installments int")
    tables = {"dim_product": products, "dim_seller": sellers, "fact": items, "orders": bought, "payments": payments, "order_keys": keys,
              "view_sales": views.sales_view(items, days, customers, geo, products, sellers, paid),
              "view_fulfillment": views.fulfillment_view(items, bought, days, products, sellers, customers)}
    return gold.CdcGoldApplier(str(root), customers, log, geo, tables, buckets=4, dim_date=days)


def whole(app):
    """Both views made from the tables as they are."""
    orders = app.table("orders")
    items = app.table("fact").drop("last_event_time").join(orders.select("order_id"), "order_id", "left_semi").withColumn("payment_sk", F.col("order_id"))
    pay = fact.primary_payment(app.table("payments")).select(F.col("order_id").alias("payment_sk"), "payment_type", "payment_installments")
    dims = app.table("dim_product"), app.table("dim_seller")
    return {"view_sales": views.sales_view(items, app.dim_date, app.table("dim_customer"), app.geo, *dims, pay),
            "view_fulfillment": views.fulfillment_view(items, orders, app.dim_date, *dims, app.table("dim_customer"))}


def batch(spark, n, *changes):
    rows = [(e, dt.datetime(2024, 2, n + 1), op, key, payload, 100 * n + i, 100 * n + i) for i, (e, op, key, payload) in enumerate(changes)]
    return spark.createDataFrame(rows, CDC_SCHEMA).withColumn("event_date", F.to_date("event_time"))


def content(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


BATCHES = [
    [("Seller", "update", "s1", '{"seller_city":"moved"}'), ("Product", "delete", "p2", "{}"), ("Seller", "delete", "s0", "{}")],
    [("OrderItem", "update", "o3|1", '{"price":"7.00"}'), ("Customer", "update", "c4", '{"customer_city":"new"}'), ("Order", "delete", "o0", "{}")],  # while p2 and s0 are away
    [("Product", "insert", "p2", '{"product_category_name":"back"}'), ("Seller", "update", "s0", '{"seller_state":"XX"}'), ("Payment", "update", "o1|1", '{"payment_type":"cash"}')],
]


def test_views_are_those_of_the_tables_after_every_batch(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 2)  # a group of buckets after the other
    app = tiny(spark, tmp_path / "g")
    for n, changes in enumerate(BATCHES):
        app(batch(spark, n, *changes), n)
        for name, want in whole(app).items():
            assert content(app.table(name)) == content(want), (n, name)
    assert app.table("view_sales").filter("product_id = 'p2'").count() and app.table("view_sales").filter("seller_id = 's0'").count()


def test_a_seller_makes_no_row_anew(spark, monkeypatch, tmp_path):
    app = tiny(spark, tmp_path / "g")
    made = []
    monkeypatch.setattr(views, "sales_view", lambda items, *more, make=views.sales_view: made.append(items.count()) or make(items, *more))
    app(batch(spark, 0, ("Seller", "update", "s1", '{"seller_city":"moved"}')), 0)
    assert made == [0]
    assert {(r.seller_id, r.seller_city) for r in app.table("view_sales").collect()} == {("s0", "town"), ("s1", "moved")}
    before = dict(app.parts.at["view_sales"])
    app(batch(spark, 1, ("Product", "update", "p9", "{}")), 1)  # in no row
    assert app.parts.at["view_sales"] == before


def test_kept_rows_may_come_in_groups(spark, tmp_path):
    p = publish.Parts(spark, str(tmp_path / "t"))
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    p.tables["t"] = publish.Table(rows(1).schema, ["id"], F.pmod("id", F.lit(4)), 1, {"repeated_key": lambda within: publish.repeated(["id"], within)}, ("id",))
    p.stage("t", rows(*range(12)))
    p.publish()
    got = p.stage("t", rows(20), [0, 1, 2, 3], [p.read("t", [0, 1]), p.read("t", [2]), p.read("t", [3]).filter("id < 9")])
    assert got == {"rows": 12, "in_another_part": 0, "repeated_key": 0, "id": 20}
    p.publish()
    assert sorted(r.id for r in p.read("t").collect()) == [*range(11), 20]
    with pytest.raises(publish.AuditError):
        p.stage("t", rows(21), [0, 1], [p.read("t", [0]), p.read("t", [0])])


def test_rows_laid_over_stand_for_those_of_their_keys(spark, monkeypatch, tmp_path):
    p = publish.Parts(spark, str(tmp_path / "t"))
    rows = lambda *pairs: spark.createDataFrame([*pairs], "id long, v string")
    table = publish.Table(rows((1, "")).schema, ["id"], F.pmod(F.coalesce("id", F.lit(0)), F.lit(4)), 1, {"repeated_key": lambda within: publish.repeated(["id"], within)})
    p.tables["t"] = table
    p.stage("t", rows(*[(i, "base") for i in range(8)], (None, "no key")))
    p.publish()
    content = lambda q, parts=None: sorted((-1 if r.id is None else r.id, r.v) for r in q.read("t", parts).collect())
    want = {-1: "no key"} | {i: "base" for i in range(8)}
    first = p.read("t", [0, 1, 2, 3]).inputFiles()
    for n, ids in enumerate([(0, 1, 9), (1, 5), (1, 12)]):
        assert p.may_lie_over("t", len(ids), [0, 1, 2, 3])
        p.stage_over("t", rows(*[(i, f"over {n}") for i in ids]), [0, 1])
        want |= {i: f"over {n}" for i in ids}
        assert content(p) == sorted(want.items())
        p.publish()
        assert set(first) <= set(p.read("t").inputFiles())  # what was there has not been written again
    assert content(p, [1]) == [(1, "over 2"), (5, "over 1"), (9, "over 0")]
    again = publish.Parts(spark, str(tmp_path / "t"))
    again.tables["t"] = table
    assert content(again) == sorted(want.items()) and not again.may_lie_over("t", 1, [0])  # rows that it has not counted
    with pytest.raises(publish.AuditError):
        p.stage_over("t", rows((1, "a"), (1, "b")), [1])
    p.discard()
    assert p.prune() == 0 and content(p) == sorted(want.items())
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 8)
    assert p.may_lie_over("t", 1, [0]) and not p.may_lie_over("t", 2, [0])
    p.stage("t", rows((1, "anew")), [1], p.read("t", [1]).filter("id != 1"))
    p.publish()
    p.publish()
    want[1] = "anew"
    assert content(p) == sorted(want.items())
    monkeypatch.setattr(publish, "MOST_LAYERS", 2)
    assert not p.may_lie_over("t", 1, [0]) and p.may_lie_over("t", 1, [1])
