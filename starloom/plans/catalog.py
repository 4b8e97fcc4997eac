"""Registered queries: ``name -> (spark, data_folder) -> DataFrame``.

Each one runs on the whole driver tables (through the source adapter) and
returns money as DOUBLE so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import publish
from starloom.functions.storage import append, matching, materialize, write_table
from starloom.operators import cdc_apply, dims, fact, quality, scd2
from starloom.plans import reports as R
from starloom.plans import views
from starloom.plans.warehouse import create_views, load, next_customers, run_day, warehouse
from starloom.session import app_key
from starloom.sources import adapter
from starloom.sources.cdc_events import ENTITY_ATTRIBUTES, change_events
from starloom.sources.schemas import land_sources, reject_report
from starloom.streaming import cdc
from starloom.streaming.gold import CdcGoldApplier
from starloom.sources.tables import load_tables

c = F.col
Query = Callable[[SparkSession, str], DataFrame]


def out(df: DataFrame) -> DataFrame:
    """DECIMAL columns -> DOUBLE (exact sums happen before this)."""
    return df.select(
        *[c(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c(f.name)
          for f in df.schema.fields]
    )


def _w(spark: SparkSession, sf: str):
    return warehouse(spark, sf)


_KEPT: dict[tuple[str, str, str], DataFrame] = {}


def _kept(name):
    """A query whose own files are made once in an application."""

    def once(query: Query) -> Query:
        def run(spark, sf):
            key = (app_key(spark), sf.rstrip("/"), name)
            if key not in _KEPT:
                _KEPT[key] = query(spark, sf)
            return _KEPT[key]

        run.__doc__ = query.__doc__
        return run

    return once


# ------------------------------------------------------------ dimensions
def q_dim_geography(spark, sf):
    return _w(spark, sf).dim_geography


def q_dim_customer_initial(spark, sf):
    return _w(spark, sf).dim_customer_initial


def q_dim_product(spark, sf):
    return _w(spark, sf).dim_product


def q_dim_payment(spark, sf):
    return _w(spark, sf).dim_payment


def q_dim_seller(spark, sf):
    return _w(spark, sf).dim_seller


def q_dim_date(spark, sf):
    return _w(spark, sf).dim_date


def q_dim_date_roles(spark, sf):
    w = _w(spark, sf)
    return dims.dim_date_roles(w.sources["orders"], w.dim_date)


def q_surrogate_keys(spark, sf):
    w = _w(spark, sf)
    s = F.col

    def nk(*cols):
        return F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("<null>")) for x in cols])

    parts = [
        w.dim_geography.select(F.lit("dim_geography").alias("dim_name"), nk(s("zip_code_prefix")).alias("natural_key"),
                               s("geography_sk").alias("sk")),
        w.dim_customer.select(F.lit("dim_customer").alias("dim_name"),
                              nk(s("customer_id"), s("effective_date")).alias("natural_key"),
                              s("customer_sk").alias("sk")),
        w.dim_product.select(F.lit("dim_product").alias("dim_name"), nk(s("product_id")).alias("natural_key"),
                             s("product_sk").alias("sk")),
        w.dim_seller.select(F.lit("dim_seller").alias("dim_name"), nk(s("seller_id")).alias("natural_key"),
                            s("seller_sk").alias("sk")),
        w.dim_payment.select(F.lit("dim_payment").alias("dim_name"),
                             nk(s("payment_type"), s("payment_installments")).alias("natural_key"),
                             s("payment_sk").alias("sk")),
        w.dim_date.select(F.lit("dim_date").alias("dim_name"), nk(s("calendar_date")).alias("natural_key"),
                          s("date_sk").alias("sk")),
    ]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ fact
def q_primary_payment(spark, sf):
    return out(fact.primary_payment(_w(spark, sf).sources["payments"]))


def q_fact_order_item(spark, sf):
    return out(_w(spark, sf).fact_order_item)


# --------------------------------------------------------------- storage
def q_table_append(spark, sf):
    """Products in two appends: the second one brings a new column."""
    w = _w(spark, sf)
    path = cdc.scratch_dir(spark, "products")
    odd = c("product_photos_qty") % 2 == 1
    append(w.dim_product.filter(odd).drop("product_name_english"), path)
    return append(w.dim_product.filter(~F.coalesce(odd, F.lit(False))), path).select(*w.dim_product.columns)


def q_table_copy(spark, sf):
    """A copy of a stored table, by way of a temporary view and SQL."""
    _w(spark, sf).dim_seller.createOrReplaceTempView("seller_copy_source")
    return write_table(spark.sql("SELECT * FROM seller_copy_source"), cdc.scratch_dir(spark, "seller-copy"))


@_kept("source_rejects")
def q_source_rejects(spark, sf):
    """Source tables exported as CSV files with broken records, taken in again: how
    many rows and rejects each has."""
    folder = cdc.scratch_dir(spark, "csv")
    adapter.export_csv(_w(spark, sf).sources, folder)
    return reject_report(*land_sources(spark, folder, header="false", **adapter.CSV_OPTIONS))


def q_view_by_sql(spark, sf):
    """New customers a month, asked in SQL by another session through the catalog."""
    w = _w(spark, sf).published()
    database = "starloom_" + w.extra["build"].rsplit("-", 1)[-1]
    if "views" not in w.extra:
        w.extra["views"] = create_views(spark, w.extra["root"], database)
    return spark.newSession().sql(f"""
        SELECT order_year, order_month, count(*) AS new_customers
        FROM (SELECT DISTINCT order_year, order_month, customer_unique_id FROM {database}.sales_items
              WHERE new_customer_flag AND customer_unique_id IS NOT NULL)
        GROUP BY order_year, order_month""")


# ------------------------------------------------------------------ SCD2
def q_scd2_snapshot_today(spark, sf):
    """A snapshot without a given date is today's: its rows and their age in days."""
    w = _w(spark, sf)
    staged = scd2.stage_snapshot(w.sources["customers_snapshot"], w.dim_geography)
    return staged.select("customer_id", "geography_sk", F.datediff(F.current_date(), "snapshot_date").alias("days_old"))


def q_scd2_sample(spark, sf):
    """Five customers to look at: the first ones by id, whatever the layout."""
    return _w(spark, sf).dim_customer.filter("current_flag").orderBy("customer_id").limit(5).select("customer_id", "customer_city", "customer_state")


def q_scd2_snapshot(spark, sf):
    return _w(spark, sf).snapshot


def q_scd2_source(spark, sf):
    w = _w(spark, sf)
    return scd2.merge_source(w.snapshot, w.dim_customer_initial)


def q_scd2_apply(spark, sf):
    return _w(spark, sf).dim_customer


def q_scd2_apply_twice(spark, sf):
    w = _w(spark, sf)
    return scd2.apply_snapshot(w.dim_customer, w.snapshot)


def q_scd2_three_days(spark, sf):
    """Three daily snapshots: each day starts from what the day before stored."""
    w = _w(spark, sf)
    root = cdc.scratch_dir(spark, "days")
    dim = write_table(w.dim_customer, f"{root}/{adapter.SNAPSHOT_DATE}/dim_customer")
    for day, customers in adapter.customers_next_days(load_tables(spark, sf)):
        _, after = next_customers(dim, customers, w.dim_geography, day)
        dim = write_table(after, f"{root}/{day}/dim_customer")
    return dim


def q_warehouse_rerun(spark, sf):
    """The first day a second time, then a later one: the customers of the whole
    stored warehouse then."""
    w = _w(spark, sf).published()
    day, customers = adapter.customers_next_days(load_tables(spark, sf))[0]
    if load(spark, w.extra["root"]).extra["day"] != day:  # not yet in this application
        run_day(w.sources, adapter.SNAPSHOT_DATE, w.extra["root"])
        run_day(w.sources, day, w.extra["root"], customers)
    return load(spark, w.extra["root"]).dim_customer


def q_scd2_history(spark, sf):
    return scd2.version_history(_w(spark, sf).dim_customer)


def customer_log(w) -> DataFrame:
    """Full-row observations so far: initial load (1900-01-01), snapshot."""
    initial = dims.stage_customers(w.sources["customers"], w.dim_geography)
    return scd2.observations(initial, dims.OPEN_START, 0).unionByName(
        scd2.observations(w.snapshot, c("snapshot_date"), 1)
    )


def q_scd2_late_arrival(spark, sf):
    w = _w(spark, sf)
    late = dims.stage_customers(w.sources["customers_late_snapshot"], w.dim_geography)
    arrivals = scd2.observations(late, adapter.LATE_SNAPSHOT_DATE, 2)
    return scd2.rebuild_timeline(w.dim_customer, customer_log(w), arrivals)


# ------------------------------------------------------------------- CDC
_BRONZE: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _cdc_run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Change events landed as JSON files, taken in by one availableNow
    stream run into the bronze table, then decoded once into silver (once
    per application and folder)."""
    key = (app_key(spark), sf.rstrip("/"))
    if key not in _BRONZE:
        root = cdc.scratch_dir(spark, "run")
        cdc.land_events(change_events(load_tables(spark, sf)["events"]), f"{root}/landing")
        cdc.run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint")
        b = cdc.read_bronze(spark, f"{root}/bronze")
        _BRONZE[key] = (b, cdc.build_silver(b))
    return _BRONZE[key]


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _cdc_run(spark, sf)[0]


def silver_decoded(spark: SparkSession, sf: str) -> DataFrame:
    return _cdc_run(spark, sf)[1]


def q_cdc_bronze(spark, sf):
    return bronze(spark, sf)


def q_cdc_silver(spark, sf):
    return cdc.silver(silver_decoded(spark, sf))


def cdc_customer_dim(spark, sf):
    w = _w(spark, sf)
    ch = lambda: cdc.entity_changes(silver_decoded(spark, sf), "Customer", ENTITY_ATTRIBUTES["Customer"])
    return _once(w, "dim_customer_cdc", lambda: cdc_apply.customer_scd2_from_events(w.dim_customer, customer_log(w), ch(), w.dim_geography))


def q_cdc_customer_scd2(spark, sf):
    return cdc_customer_dim(spark, sf)


def _changes(spark, sf, entity):
    return cdc.entity_changes(silver_decoded(spark, sf), entity, ENTITY_ATTRIBUTES[entity])


def _once(w, name, make):
    """A table of the warehouse's CDC run, made and written once."""
    if name not in w.extra:
        w.extra[name] = materialize(make(), name)
    return w.extra[name]


PRODUCT_ATTRS = {"product_category_name": "string", "product_weight_g": "int"}
SELLER_ATTRS = {"seller_city": "string", "seller_state": "string"}


def q_cdc_quarantine(spark, sf):
    return cdc.quarantine_counts(bronze(spark, sf))


def q_cdc_type1_upsert(spark, sf):
    w = _w(spark, sf)
    return _once(w, "dim_product_cdc", lambda: cdc_apply.current(cdc_apply.type1_upsert(
        w.dim_product, _changes(spark, sf, "Product"), "product_id", PRODUCT_ATTRS, sk_col="product_sk")))


def q_cdc_type1_two_runs(spark, sf):
    """The same events in two runs, the second one with the earlier arrivals:
    the stored state makes the order of runs meaningless."""
    w, ch = _w(spark, sf), _changes(spark, sf, "Product")
    early = c("arrival_seq") % 2 == 0
    first = cdc_apply.type1_upsert(w.dim_product, ch.filter(~early), "product_id", PRODUCT_ATTRS, sk_col="product_sk")
    first = materialize(first, "dim_product-first-run")
    second = cdc_apply.type1_upsert(first, ch.filter(early), "product_id", PRODUCT_ATTRS, sk_col="product_sk")
    return cdc_apply.current(second).drop("product_sk")


def q_cdc_type1_upsert_seller(spark, sf):
    w = _w(spark, sf)
    return _once(w, "dim_seller_cdc", lambda: cdc_apply.current(cdc_apply.type1_upsert(
        w.dim_seller, _changes(spark, sf, "Seller"), "seller_id", SELLER_ATTRS, sk_col="seller_sk")))


def _order_level(w, orders=None, payments=None, dim_customer=None, dim_payment=None):
    return fact.order_level(
        w.sources["orders"] if orders is None else orders,
        w.sources["payments"] if payments is None else payments,
        w.dim_customer if dim_customer is None else dim_customer,
        w.dim_geography,
        w.dim_date,
        w.dim_payment if dim_payment is None else dim_payment,
    )


def _level_of(w, orders=None, payments=None, **more):
    """The order level of some orders alone."""

    def level(named):
        own = lambda df: df.join(named, "order_id", "left_semi")
        return _order_level(w, own(w.sources["orders"] if orders is None else orders), own(w.sources["payments"] if payments is None else payments), **more)

    return level


def fact_cdc(spark, sf):
    w = _w(spark, sf)
    return _once(w, "fact_cdc", lambda: cdc_apply.current(cdc_apply.fact_upsert(
        w.fact_order_item, _changes(spark, sf, "OrderItem"), dim_product=w.dim_product, dim_seller=w.dim_seller,
        orders=_level_of(w))))


@_kept("cdc_fact_partition_upsert")
def q_cdc_fact_partition_upsert(spark, sf):
    """The fact by month: events open only the months that the lookup beside it names."""
    w = _w(spark, sf)
    monthly = cdc_apply.MonthlyFact(spark, cdc.scratch_dir(spark, "fact-by-month"), w.dim_date).create(w.fact_order_item)
    changes = cdc_apply.item_changes(_changes(spark, sf, "OrderItem"), w.dim_product, w.dim_seller)
    monthly.upsert(None, cdc_apply._fold(changes, cdc_apply.FACT_KEYS, cdc_apply.ITEM_ATTRS), orders=_level_of(w))
    return out(monthly.read())


def q_cdc_fact_upsert(spark, sf):
    return out(fact_cdc(spark, sf))


def orders_cdc(spark, sf):
    w = _w(spark, sf)
    return _once(w, "orders_cdc", lambda: cdc_apply.current(cdc_apply.type1_upsert(
        w.sources["orders"], _changes(spark, sf, "Order"), "order_id", cdc_apply.ORDER_ATTRS)))


def payments_cdc(spark, sf):
    w = _w(spark, sf)
    return _once(w, "payments_cdc", lambda: cdc_apply.current(cdc_apply.payment_upsert(
        w.sources["payments"], _changes(spark, sf, "Payment"))))


def dim_payment_cdc(spark, sf):
    w = _w(spark, sf)
    return _once(w, "dim_payment_cdc", lambda: dims.build_dim_payment(payments_cdc(spark, sf), w.dim_payment))


def q_cdc_order_upsert(spark, sf):
    return orders_cdc(spark, sf)


def q_cdc_payment_upsert(spark, sf):
    """The fact's payment keys after payment events."""
    w, pay = _w(spark, sf), dim_payment_cdc(spark, sf)
    paid = cdc_apply.split_key(_changes(spark, sf, "Payment"), "payment_sequential").select("order_id").distinct()
    moved = cdc_apply.move_order_keys(
        w.fact_order_item, materialize(paid, "orders-paid"), _level_of(w, payments=payments_cdc(spark, sf), dim_payment=pay))
    return moved.join(pay, "payment_sk", "left").select(
        "order_id", "order_item_id", "payment_sk", "payment_type", "payment_installments")


def _after_events(spark, sf):
    """Every table after the events, and the closed set of orders that they can
    change in a view; items of deleted orders are gone."""
    w, pay, customers = _w(spark, sf), dim_payment_cdc(spark, sf), cdc_customer_dim(spark, sf)
    orders, products, sellers = orders_cdc(spark, sf), q_cdc_type1_upsert(spark, sf), q_cdc_type1_upsert_seller(spark, sf)

    def keys(entity):
        return silver_decoded(spark, sf).filter(c("entity_name") == entity).select("primary_key")

    paired = keys("OrderItem").union(keys("Payment")).select(F.split("primary_key", r"\|")[0].alias("order_id"))
    touched = _once(w, "orders_touched", lambda: paired.union(keys("Order")).distinct())
    level = _level_of(w, orders, payments_cdc(spark, sf), dim_customer=customers, dim_payment=pay)
    left = lambda: matching(fact_cdc(spark, sf).drop("last_event_time"), orders, "order_id")
    f = _once(w, "fact_after", lambda: cdc_apply.move_order_keys(left(), touched, level))

    def numbers(entity, dims_, key, sk):
        """Keys of the rows that the entity's events name, before and after."""
        names = keys(entity).select(c("primary_key").alias(key)).distinct()
        return dims_[0].select(key, sk).union(dims_[1].select(key, sk)).join(names, key, "left_semi").select(sk).distinct()

    refresh = _once(w, "orders_to_refresh", lambda: views.orders_to_refresh(
        touched, [w.fact_order_item, f], customers.select("customer_id", "customer_unique_id").union(
            w.dim_customer.select("customer_id", "customer_unique_id")),
        keys("Customer").select(c("primary_key").alias("customer_id")).distinct(),
        numbers("Product", (w.dim_product, products), "product_id", "product_sk"),
        numbers("Seller", (w.dim_seller, sellers), "seller_id", "seller_sk")))
    return w, refresh, f, orders, customers, products, sellers, pay


def q_view_sales_after_cdc(spark, sf):
    """The sales view refreshed for what the events touched, in all its tables."""
    w, refresh, f, _, customers, products, sellers, pay = _after_events(spark, sf)
    return out(views.refresh_sales_view(w.sales, refresh, f, w.dim_date, customers, w.dim_geography, products, sellers, pay))


def q_view_fulfillment_after_cdc(spark, sf):
    """The fulfilment view refreshed for the same orders."""
    w, refresh, f, orders, customers, products, sellers, _ = _after_events(spark, sf)
    return out(views.refresh_fulfillment_view(w.fulfillment, refresh, f, orders, w.dim_date, products, sellers, customers))


@_kept("cdc_publish_gate")
def q_cdc_publish_gate(spark, sf):
    """What the gate lets through: customers and fact after the events, then versions
    added without closing the old ones, then items appended without a merge. One row
    an attempt: its rows, its violations, and the rows readers see after it."""
    w = _w(spark, sf)
    customers, items = cdc_customer_dim(spark, sf), fact_cdc(spark, sf).drop("last_event_time")
    parts = publish.Parts(spark, cdc.scratch_dir(spark, "gate"))
    slice_of = lambda key: F.pmod(F.xxhash64(key), F.lit(16))
    parts.tables = {
        "dim_customer": publish.Table(customers.schema, [scd2.KEY], slice_of(scd2.KEY), checks={"violations": partial(publish.second_current, scd2.KEY)}),
        "fact": publish.Table(items.schema, cdc_apply.FACT_KEYS, slice_of("order_id"), checks={"violations": partial(publish.repeated, cdc_apply.FACT_KEYS)}),
    }
    attempts = [
        ("dim_customer", customers), ("fact", items),
        ("dim_customer", w.dim_customer.unionByName(customers.filter("current_flag"))), ("fact", w.fact_order_item.unionByName(items)),
    ]
    seen = []
    for n, (name, rows) in enumerate(attempts):
        try:
            counts = parts.stage(name, rows)
            parts.publish()
        except publish.AuditError as e:
            counts = e.counts
            parts.discard()
        seen.append((n + 1, name, counts["rows"], counts.get("violations", 0), "violations" not in counts or not counts["violations"], parts.read(name).count()))
    return spark.createDataFrame(seen, "attempt int, table_name string, n_rows long, violations long, published boolean, n_visible long")


@_kept("cdc_stream_dedup")
def q_cdc_stream_dedup(spark, sf):
    """Bronze of a feed that delivers events again, within a run and in a later run
    of the stream, which goes on from its checkpoint: each event once."""
    root = cdc.scratch_dir(spark, "dedup")
    feed = change_events(load_tables(spark, sf)["events"])
    late = cdc.lateness(feed)
    first, again = feed.filter("arrival_seq % 3 < 2"), feed.filter("arrival_seq % 3 > 0")
    for delivery in (first, first, again, feed):
        cdc.land_events(delivery, f"{root}/landing")
        cdc.run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint", dedup_watermark=late)
    return cdc.read_bronze(spark, f"{root}/bronze")


@_kept("cdc_bronze_compacted")
def q_cdc_bronze_compacted(spark, sf):
    """Bronze of many small micro-batches, packed, with more arriving after it."""
    root = cdc.scratch_dir(spark, "packed")
    feed = change_events(load_tables(spark, sf)["events"])
    packed = cdc.CompactedBronze(spark, f"{root}/bronze", f"{root}/packed")
    for k in range(2):
        cdc.land_events(feed.filter(c("arrival_seq") % 2 == k), f"{root}/landing", files=4)
        cdc.run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint", max_files_per_trigger=1)
        if k == 0:
            packed.compact()
    return packed.read()


def _gold(spark, sf):
    """The foreachBatch applier, run over three micro-batches of the events."""
    w = _w(spark, sf)
    if "gold" not in w.extra:
        root = cdc.scratch_dir(spark, "gold-run")
        files = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))  # as many as the cluster is set up for
        cdc.land_events(change_events(load_tables(spark, sf)["events"]), f"{root}/landing", files=files)
        tables = {"dim_product": w.dim_product, "dim_seller": w.dim_seller, "fact": w.fact_order_item,
                  "orders": w.sources["orders"], "payments": w.sources["payments"], "order_keys": _once(w, "order_level", lambda: _order_level(w)),
                  "view_sales": w.sales, "view_fulfillment": w.fulfillment}
        app = CdcGoldApplier(f"{root}/gold", w.dim_customer, customer_log(w), w.dim_geography, tables, dim_date=w.dim_date)
        cdc.run_cdc_batches(spark, f"{root}/landing", f"{root}/_checkpoint", app, max_files_per_trigger=-(-files // 3))
        w.extra["gold"] = app
    return w.extra["gold"]


def q_cdc_gold_customer(spark, sf):
    return _gold(spark, sf).table("dim_customer").drop("customer_sk")  # numbers of new keys follow arrival


def q_cdc_gold_product(spark, sf):
    return _gold(spark, sf).table("dim_product").drop("product_sk")


def q_cdc_gold_fact(spark, sf):
    return out(_gold(spark, sf).table("fact"))


def q_cdc_gold_payments(spark, sf):
    return out(_gold(spark, sf).table("payments"))


def q_cdc_gold_view_sales(spark, sf):
    return out(_gold(spark, sf).table("view_sales"))


def q_cdc_gold_view_fulfillment(spark, sf):
    return out(_gold(spark, sf).table("view_fulfillment"))


# --------------------------------------------------------------- quality
def q_dq_duplicate_keys(spark, sf):
    w = _w(spark, sf)
    src = w.sources
    li = load_tables(spark, sf)["lineitem"]
    return quality.duplicate_keys_all(
        [
            (src["customers"], ["customer_id"], "customers"),
            (src["customers_snapshot"], ["customer_id"], "customers_snapshot"),
            (src["orders"], ["order_id"], "orders"),
            (src["products"], ["product_id"], "products"),
            (src["sellers"], ["seller_id"], "sellers"),
            (src["order_items"], ["order_id", "order_item_id"], "order_items"),
            (src["payments"], ["order_id", "payment_sequential"], "payments"),
            (li, ["l_orderkey", "l_linenumber"], "lineitem"),
        ]
    )


def q_dq_one_current(spark, sf):
    w = _w(spark, sf)
    return quality.current_version_histogram(w.dim_customer).withColumn(
        "dim_name", F.lit("dim_customer")
    ).unionByName(
        quality.current_version_histogram(cdc_customer_dim(spark, sf)).withColumn(
            "dim_name", F.lit("dim_customer_cdc")
        )
    )


def q_dq_fact_grain(spark, sf):
    w = _w(spark, sf)
    li = load_tables(spark, sf)["lineitem"]
    return quality.fact_grain(li, "l_orderkey", "l_linenumber", "lineitem").unionByName(
        quality.fact_grain(w.fact_order_item, "order_id", "order_item_id", "fact_order_item")
    )


def q_dq_rows_without_version(spark, sf):
    w = _w(spark, sf)
    return quality.rows_without_version(w.fact_order_item, w.dim_date, w.dim_customer)


# ----------------------------------------------------------------- views
def q_view_sales(spark, sf):
    return out(_w(spark, sf).sales)


def q_first_order(spark, sf):
    w = _w(spark, sf)
    return views.first_order(w.fact_order_item, w.dim_date, w.dim_customer)


def q_view_fulfillment(spark, sf):
    return out(_w(spark, sf).fulfillment)


def _sales_report(fn):
    return lambda spark, sf: fn(_w(spark, sf).sales)


def _ful_report(fn):
    return lambda spark, sf: fn(_w(spark, sf).fulfillment)


QUERIES: dict[str, Query] = {
    "dim_geography": q_dim_geography,
    "dim_customer_initial": q_dim_customer_initial,
    "dim_product": q_dim_product,
    "dim_payment": q_dim_payment,
    "dim_seller": q_dim_seller,
    "dim_date": q_dim_date,
    "dim_date_roles": q_dim_date_roles,
    "surrogate_keys": q_surrogate_keys,
    "primary_payment": q_primary_payment,
    "fact_order_item": q_fact_order_item,
    "table_append": q_table_append,
    "table_copy": q_table_copy,
    "source_rejects": q_source_rejects,
    "view_by_sql": q_view_by_sql,
    "scd2_snapshot": q_scd2_snapshot,
    "scd2_snapshot_today": q_scd2_snapshot_today,
    "scd2_sample": q_scd2_sample,
    "scd2_source": q_scd2_source,
    "scd2_apply": q_scd2_apply,
    "scd2_apply_twice": q_scd2_apply_twice,
    "scd2_three_days": q_scd2_three_days,
    "warehouse_rerun": q_warehouse_rerun,
    "scd2_history": q_scd2_history,
    "scd2_late_arrival": q_scd2_late_arrival,
    "cdc_bronze": q_cdc_bronze,
    "cdc_silver": q_cdc_silver,
    "cdc_customer_scd2": q_cdc_customer_scd2,
    "cdc_quarantine": q_cdc_quarantine,
    "cdc_type1_upsert": q_cdc_type1_upsert,
    "cdc_type1_two_runs": q_cdc_type1_two_runs,
    "cdc_type1_upsert_seller": q_cdc_type1_upsert_seller,
    "cdc_fact_upsert": q_cdc_fact_upsert,
    "cdc_order_upsert": q_cdc_order_upsert,
    "cdc_payment_upsert": q_cdc_payment_upsert,
    "cdc_fact_partition_upsert": q_cdc_fact_partition_upsert,
    "cdc_publish_gate": q_cdc_publish_gate,
    "cdc_stream_dedup": q_cdc_stream_dedup,
    "cdc_bronze_compacted": q_cdc_bronze_compacted,
    "cdc_gold_customer": q_cdc_gold_customer,
    "cdc_gold_product": q_cdc_gold_product,
    "cdc_gold_fact": q_cdc_gold_fact,
    "cdc_gold_payments": q_cdc_gold_payments,
    "cdc_gold_view_sales": q_cdc_gold_view_sales,
    "cdc_gold_view_fulfillment": q_cdc_gold_view_fulfillment,
    "view_sales_after_cdc": q_view_sales_after_cdc,
    "view_fulfillment_after_cdc": q_view_fulfillment_after_cdc,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_one_current": q_dq_one_current,
    "dq_fact_grain": q_dq_fact_grain,
    "dq_rows_without_version": q_dq_rows_without_version,
    "view_sales": q_view_sales,
    "first_order": q_first_order,
    "view_fulfillment": q_view_fulfillment,
    "q_daily_sales": _sales_report(R.q_daily_sales),
    "q_monthly_sales": _sales_report(R.q_monthly_sales),
    "q_revenue_by_category": _sales_report(R.q_revenue_by_category),
    "q_revenue_by_seller": _sales_report(R.q_revenue_by_seller),
    "q_top_category_state": _sales_report(R.q_top_category_state),
    "q_top_seller_category": _sales_report(R.q_top_seller_category),
    "q_new_customers": _sales_report(R.q_new_customers),
    "q_basket_by_state": _sales_report(R.q_basket_by_state),
    "q_spend_by_version": _sales_report(R.q_spend_by_version),
    "q_revenue_by_seller_state": _sales_report(R.q_revenue_by_seller_state),
    "q_payment_mix": _sales_report(R.q_payment_mix),
    "q_delivery_by_state": _ful_report(R.q_delivery_by_state),
    "q_delivery_by_category": _ful_report(R.q_delivery_by_category),
    "q_seller_speed": _ful_report(R.q_seller_speed),
    "q_seller_speed_200": _ful_report(lambda ful: R.q_seller_speed(ful, min_orders=200)),
    "q_late_rate": _ful_report(R.q_late_rate),
}
