"""Driver tables (TPC-H-like) -> retail source shapes.

The warehouse logic only knows the retail source tables (customers, orders,
order_items, payments, products, category translation, sellers,
geolocation). The test data is a TPC-H-like star, so this module projects it
onto those shapes with integer/decimal/date/string expressions that Spark and
DuckDB evaluate identically. Every row of every driver table flows through;
the few ``%`` rules below decide *values* (a NULL, a moved customer, an orphan
product id) so that each edge case of the model has data, they never sample.

All functions are lazy and narrow except ``order_lines``, which gives every
line a unique item number within its order; it is made when items or payments are
asked for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.keys import assign_surrogate_keys
from starloom.sources.schemas import MONEY, SOURCE_SCHEMAS, conform

# Fixed values of the data shaping (dates of the customer snapshots and the
# category names that have an English translation).
SNAPSHOT_DATE = dt.date(1999, 1, 1)
LATE_SNAPSHOT_DATE = dt.date(1998, 7, 1)
NEXT_DATES = [dt.date(1999, 1, 2), dt.date(1999, 1, 3)]
TRANSLATED_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]

c = F.col


def _city(nation: F.Column) -> F.Column:
    return F.concat(F.lit("city_"), nation.cast("string"))


def _customer_zip(df: DataFrame, nation: F.Column) -> F.Column:
    return F.when(c("c_custkey") % 97 == 0, F.lit(None)).otherwise(nation).cast("int")


def customers_all(t) -> DataFrame:
    """Every driver customer in source shape, as first seen."""
    cu = t["customer"]
    return conform(
        cu.select(
            c("c_custkey").cast("string").alias("customer_id"),
            F.expr("c_custkey div 2").cast("string").alias("customer_unique_id"),
            _customer_zip(cu, c("c_nationkey")).alias("customer_zip_code_prefix"),
            _city(c("c_nationkey")).alias("customer_city"),
            c("c_mktsegment").alias("customer_state"),
        ),
        "customers",
    )


def _also(df: DataFrame, rows: F.Column, prefix: str) -> DataFrame:
    """``df`` and, for some of its rows, another customer like it, whose id
    has a prefix: every row stays, new keys come from existing rows."""
    more = df.filter(rows).withColumn("customer_id", F.concat(F.lit(prefix), "customer_id"))
    return df.unionByName(more)


def customers_initial(t) -> DataFrame:
    """Customers known at the initial load: every one, and some 'old-' keys
    that no later snapshot has."""
    return _also(customers_all(t), c("customer_id").cast("bigint") % 13 == 0, "old-")


def customers_snapshot(t) -> DataFrame:
    """Customer table as of SNAPSHOT_DATE: every customer, some moved to another
    nation (zip+city), some with a new state, some with a NULL city, and 'new-'
    keys that the initial load does not have."""
    cu = t["customer"]
    nation = F.when(c("c_custkey") % 7 == 0, (c("c_nationkey") + 1) % 25).otherwise(c("c_nationkey"))
    rows = conform(
        cu.select(
            c("c_custkey").cast("string").alias("customer_id"),
            F.expr("c_custkey div 2").cast("string").alias("customer_unique_id"),
            _customer_zip(cu, nation).alias("customer_zip_code_prefix"),
            F.when(c("c_custkey") % 17 == 0, F.lit(None)).otherwise(_city(nation)).alias("customer_city"),
            F.when(c("c_custkey") % 11 == 0, F.lit("MOVED")).otherwise(c("c_mktsegment")).alias("customer_state"),
        ),
        "customers",
    )
    return _also(rows, c("customer_id").cast("bigint") % 10 == 9, "new-")


def customers_next_days(t) -> list[tuple[dt.date, DataFrame]]:
    """Two more daily snapshots after SNAPSHOT_DATE: on the first, customers
    with ids divisible by 19 have a new state; on the second, all are as first
    seen again, and there are 'late-' keys."""
    base = customers_all(t)
    k = c("customer_id").cast("bigint")
    first = base.withColumn("customer_state", F.when(k % 19 == 0, F.lit("NEXT")).otherwise(c("customer_state")))
    return [(NEXT_DATES[0], first), (NEXT_DATES[1], _also(base, k % 23 == 0, "late-"))]


def customers_late_snapshot(t) -> DataFrame:
    """A snapshot dated LATE_SNAPSHOT_DATE (before SNAPSHOT_DATE) that arrives
    after it: every customer, state 'LATE' for ids divisible by 3."""
    base = customers_all(t)
    return base.withColumn(
        "customer_state",
        F.when(c("customer_id").cast("bigint") % 3 == 0, F.lit("LATE")).otherwise(c("customer_state")),
    )


def products(t) -> DataFrame:
    p = t["part"]
    return conform(
        p.select(
            c("p_partkey").cast("string").alias("product_id"),
            F.when(c("p_partkey") % 50 == 0, F.lit(None)).otherwise(c("p_type")).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (c("p_size") * 10).alias("product_description_lenght"),
            (c("p_partkey") % 5).alias("product_photos_qty"),
            c("p_size").alias("product_weight_g"),
            (c("p_size") + 1).alias("product_length_cm"),
            (c("p_size") + 2).alias("product_height_cm"),
            (c("p_size") + 3).alias("product_width_cm"),
        ),
        "products",
    )


def category_translation(t) -> DataFrame:
    """Translation lookup: one row per translated category name, derived from
    the categories present in ``part`` (STANDARD stays untranslated)."""
    cats = t["part"].select(c("p_type").alias("product_category_name")).filter(
        c("product_category_name").isin(TRANSLATED_CATEGORIES)
    )
    return conform(
        cats.distinct().withColumn("product_category_name_english", F.lower("product_category_name")),
        "category_translation",
    )


def sellers(t) -> DataFrame:
    s = t["supplier"]
    return conform(
        s.select(
            c("s_suppkey").cast("string").alias("seller_id"),
            c("s_nationkey").alias("seller_zip_code_prefix"),
            _city(c("s_nationkey")).alias("seller_city"),
            F.concat(F.lit("S"), (c("s_nationkey") % 5).cast("string")).alias("seller_state"),
        ),
        "sellers",
    )


def geolocation(t) -> DataFrame:
    """Many points per zip. Customer points spell the zip zero-padded, supplier
    points unpadded, so one integer zip has two raw spellings. Points of
    nation 24 have a zip that is no number (so its zip has no geography)."""

    def points(df: DataFrame, key: str, nation: str, zip_col: F.Column) -> DataFrame:
        return df.select(
            F.when(c(nation) == 24, "unknown").otherwise(zip_col).alias("geolocation_zip_code_prefix"),
            (c(nation) + c(key) % 10).cast("double").alias("geolocation_lat"),
            (-(c(key) % 100)).cast("double").alias("geolocation_lng"),
            _city(c(nation)).alias("geolocation_city"),
            F.concat(F.lit("S"), (c(nation) % 5).cast("string")).alias("geolocation_state"),
        )

    cust = points(t["customer"], "c_custkey", "c_nationkey", F.lpad(c("c_nationkey").cast("string"), 5, "0"))
    supp = points(t["supplier"], "s_suppkey", "s_nationkey", c("s_nationkey").cast("string"))
    return conform(cust.unionByName(supp), "geolocation")


def _days(ts: F.Column, n: F.Column) -> F.Column:
    return ts + F.make_dt_interval(days=n.cast("int"))


def orders(t) -> DataFrame:
    o = t["orders"]
    k = c("o_orderkey")
    status = F.when(c("o_orderstatus") == "F", "delivered").when(c("o_orderstatus") == "O", "shipped").when(
        c("o_orderstatus") == "P", "processing"
    )
    delivered = F.when((c("o_orderstatus") == "F") & (k % 50 != 0), _days(c("o_orderdate"), 3 + k % 17))
    return conform(
        o.select(
            k.cast("string").alias("order_id"),
            F.concat(
                F.when((c("o_custkey") % 10 == 9) & (k % 2 == 0), "new-").otherwise(""), c("o_custkey").cast("string")
            ).alias("customer_id"),
            status.alias("order_status"),
            c("o_orderdate").alias("order_purchase_timestamp"),
            _days(c("o_orderdate"), k % 3).alias("order_approved_at"),
            _days(c("o_orderdate"), 1 + k % 5).alias("order_delivered_carrier_date"),
            delivered.alias("order_delivered_customer_date"),
            _days(c("o_orderdate"), 12 + k % 4).alias("order_estimated_delivery_date"),
        ),
        "orders",
    )


ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


HOT_LINES = 100_000  # lines of an order that one task puts in order
LINE_BUCKETS = 1 << 14


def orders_with_many_lines(li: DataFrame, hot: int = HOT_LINES) -> DataFrame:
    """Orders with more than ``hot`` lines. Lines are first counted by bucket of the
    order, which shuffles next to nothing; the orders of buckets that hold so many
    lines are then counted one by one."""
    bucket = F.pmod(F.xxhash64("l_orderkey"), F.lit(LINE_BUCKETS)).alias("_b")
    crowded = li.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).filter(c("n") > hot).select("_b")
    own = li.select("l_orderkey", bucket).join(F.broadcast(crowded), "_b", "left_semi")  # at most LINE_BUCKETS
    return own.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter(c("n") > hot).select("l_orderkey")


def order_lines(t, hot: int = HOT_LINES) -> DataFrame:
    """lineitem with a unique item number per order ((orderkey, linenumber)
    repeats in the driver data): ``row_number() OVER (PARTITION BY orderkey
    ORDER BY line columns)``. An order with more than ``hot`` lines would be too much
    for one task; such orders are numbered by ``_ranked_lines``."""
    from starloom.functions.storage import if_small, materialize

    li = t["lineitem"].filter(c("l_orderkey").isNotNull())
    w = Window.partitionBy("l_orderkey").orderBy(*[c(x).asc_nulls_first() for x in ITEM_ORDER])
    many = materialize(orders_with_many_lines(li, hot), "orders-with-many-lines")
    number = lambda lines: lines.withColumn("item_no", F.row_number().over(w))
    if many.isEmpty():
        return number(li)
    many = if_small(many)
    return number(li.join(many, "l_orderkey", "left_anti")).unionByName(_ranked_lines(li.join(many, "l_orderkey", "left_semi")))


def _ranked_lines(li: DataFrame) -> DataFrame:
    """The same numbers without a per-order window: lines get a global dense rank in
    (orderkey, line columns) order (range partitioning splits a big order across
    ranges); the item number is the rank minus the order's first rank, whose
    per-order min is a map-side-combined aggregate."""
    ranked = assign_surrogate_keys(li, ["l_orderkey", *ITEM_ORDER], "_line_rank")
    first = ranked.groupBy("l_orderkey").agg(F.min("_line_rank").alias("_first_rank"))
    return (
        ranked.join(first, "l_orderkey")
        .withColumn("item_no", (c("_line_rank") - c("_first_rank") + 1).cast("int"))
        .drop("_line_rank", "_first_rank")
    )


def order_items(t, lines: DataFrame | None = None) -> DataFrame:
    li = lines if lines is not None else order_lines(t)
    price = c("l_extendedprice").cast(MONEY)
    product = F.when(c("l_orderkey") % 101 == 0, c("l_partkey") + 1000000).otherwise(c("l_partkey"))
    return conform(
        li.select(
            c("l_orderkey").cast("string").alias("order_id"),
            c("item_no").alias("order_item_id"),
            product.cast("string").alias("product_id"),
            c("l_suppkey").cast("string").alias("seller_id"),
            c("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            (price * c("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("freight_value"),
        ),
        "order_items",
    )


def payments(t, lines: DataFrame | None = None) -> DataFrame:
    li = lines if lines is not None else order_lines(t)
    return conform(
        li.select(
            c("l_orderkey").cast("string").alias("order_id"),
            c("item_no").alias("payment_sequential"),
            F.when(c("l_orderkey") % 61 == 0, F.lit(None))
            .otherwise(F.concat("l_returnflag", "l_linestatus"))
            .alias("payment_type"),
            (c("l_quantity").cast("int") % 12 + 1).alias("payment_installments"),
            F.floor(c("l_extendedprice") / 10000).cast(MONEY).alias("payment_value"),
        ),
        "payments",
    )


#: What items and payments read of the numbered lines.
LINE_COLUMNS = [
    "l_orderkey", "item_no", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax", "l_quantity",
    "l_returnflag", "l_linestatus",
]


class RetailSources(dict):
    """Source tables by name. Numbered lines feed items, payments and the checks:
    they are landed once, when the first of these is asked for."""

    def __init__(self, t):
        super().__init__({
            "customers": customers_initial(t),
            "customers_snapshot": customers_snapshot(t),
            "customers_late_snapshot": customers_late_snapshot(t),
            "products": products(t),
            "category_translation": category_translation(t),
            "sellers": sellers(t),
            "geolocation": geolocation(t),
            "orders": orders(t),
        })
        self.t = t

    def __missing__(self, name: str) -> DataFrame:
        from starloom.functions.storage import table_path, temporary, write_table

        if name not in ("order_items", "payments"):
            raise KeyError(name)
        with temporary(self["orders"].sparkSession):
            lines = order_lines(self.t).select(*LINE_COLUMNS)
            lines = write_table(lines, table_path(lines, "order_lines"))
        self["order_items"], self["payments"] = order_items(self.t, lines), payments(self.t, lines)
        return self[name]


def retail_sources(t) -> RetailSources:
    return RetailSources(t)


#: Tables whose files get broken records: for every row with such a number in its
#: first column, its line once more with two values too many.
BROKEN_EVERY = {"customers": 97, "products": 40, "sellers": 9, "orders": 83, "order_items": 71, "payments": 71}


#: How the exported files spell a time.
CSV_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def export_csv(sources: dict[str, DataFrame], folder: str) -> None:
    """Source tables as CSV files without a header in ``folder/<name>``, some records
    of them broken: what an upstream system leaves."""
    for name in SOURCE_SCHEMAS:
        df, every = sources[name], BROKEN_EVERY.get(name)
        lines = df.select(F.to_csv(F.struct(*df.columns), CSV_OPTIONS).alias("value"), c(df.columns[0]).try_cast("bigint").alias("n"))
        out = lines.select("value")
        if every:
            out = out.unionByName(lines.filter(c("n") % every == 0).select(F.concat("value", F.lit(",1,2")).alias("value")))
        out.write.mode("errorifexists").option("compression", "gzip").text(f"{folder}/{name}")
