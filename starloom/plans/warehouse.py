"""End-to-end build: sources -> dimensions -> SCD2 snapshot -> fact -> views.

Build order fixes two hazards of a top-to-bottom script: geography is built
before the dimensions that look it up, and the customer dimension gets its
initial load once and then only snapshot merges, so history is kept.

A daily run is ``run_day(sources, day, root)``: the customer dimension goes on from
the versions of the last build of an earlier day, and every dimension keeps its
keys. Every attempt has a folder of its own; the last step publishes it as the build
that ``load`` sees, also in another session. So a day can be run again, with the same
or with corrected tables, and a build that fails changes nothing. Customer versions
and the fact's grain are checked once they are written, and a violation ends the
build before it is published. ``prune`` deletes attempts that are no longer needed.
Without a root the tables go to the session's checkpoint folder. Every table is
written once; reports read it instead of re-expanding the plans.

``build`` makes all tables. ``warehouse``, which the queries share, makes a table
when one asks for it (``Growing``), with those that it is made from, by the same
steps; ``published`` makes what is missing and publishes the whole build.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starloom.functions import publish
from starloom.functions.storage import table_path, temporary, write_table
from starloom.operators import dims, fact, quality, scd2
from starloom.plans import views
from starloom.session import app_key, checkpoint_root
from starloom.sources import adapter
from starloom.sources.tables import load_tables


@dataclass
class Warehouse:
    sources: dict[str, DataFrame]
    dim_geography: DataFrame
    dim_customer_initial: DataFrame
    snapshot: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_payment: DataFrame
    dim_seller: DataFrame
    dim_date: DataFrame
    fact_order_item: DataFrame
    sales: DataFrame
    fulfillment: DataFrame
    extra: dict = field(default_factory=dict)


#: Stored tables of a build, in the order they are written.
TABLES = [
    "dim_geography", "dim_customer_initial", "dim_product", "dim_payment", "dim_seller", "dim_date",
    "dim_customer", "fact_order_item", "sales", "fulfillment", "snapshot",
]
Land = Callable[[DataFrame, str], DataFrame]


#: What must not be in a table of a build, looked for in its written key columns
#: (grouped counts with map-side combine; the wide rows are not shuffled again).
CHECKS = {
    "dim_customer": lambda df: quality.one_current_violations(df.filter(f"{scd2.KEY} is not null"), allow_zero=True),
    "fact_order_item": lambda df: quality.fact_grain(df, "order_id", "order_item_id", "fact_order_item"),
}


def _lander(root: str | None, build: str, seconds: dict[str, float]) -> Land:
    """Writes a table of a build, below the root if there is one, ends the build if
    the table holds what it must not, and notes the seconds."""

    def land(df: DataFrame, name: str) -> DataFrame:
        began = time.time()
        out = write_table(df, f"{root}/{build}/{name}" if root else table_path(df, name))
        if name in CHECKS and (bad := CHECKS[name](out).count()):
            raise publish.AuditError(name, {"violations": bad})
        seconds[name] = round(time.time() - began, 3)
        return out

    return land


def next_customers(dim_customer: DataFrame, customers: DataFrame, dim_geography: DataFrame, day: dt.date) -> tuple[DataFrame, DataFrame]:
    """(staged snapshot, customer dimension) after one more day."""
    staged = scd2.stage_snapshot(customers, dim_geography, day)
    return staged, scd2.apply_snapshot(dim_customer, staged)


class Growing(Warehouse):
    """A build whose tables are made, landed and checked when they are first read.
    ``previous``: an earlier build whose surrogate keys must stay valid. The initial
    load happens once: later builds keep the first one's."""

    def __init__(self, src: dict[str, DataFrame], day: dt.date, previous: Warehouse | None, root: str | None, customers: DataFrame | None):
        self.sources, self.day, self.previous, self.root, self.customers = src, day, previous, root, customers
        self.spark = src["customers"].sparkSession
        self.name = f"build-{day}-{uuid.uuid4().hex[:8]}"
        self.extra = {"seconds": {}}
        self._land = _lander(root, self.name, self.extra["seconds"])

    def __getattr__(self, name: str) -> DataFrame:  # of what is not there yet
        if name not in TABLES:
            raise AttributeError(name)
        with temporary(self.spark):
            df = getattr(self, f"_make_{name}")()
            # a snapshot that is not stored stays a plan
            df = self._land(df, name) if name != "snapshot" or self.root else df
        setattr(self, name, df)
        return df

    def published(self) -> "Growing":
        """All tables; the build is what ``load`` sees, if there is a root."""
        for name in TABLES:
            getattr(self, name)
        if self.root and "build" not in self.extra:
            self.extra["build"] = self.name
            publish.note_build(self.spark, self.root, self.day, self.name)
        return self

    def _before(self, name: str) -> DataFrame | None:
        return getattr(self.previous, name) if self.previous is not None else None

    def _make_dim_geography(self) -> DataFrame:
        return dims.build_dim_geography(self.sources["geolocation"], self._before("dim_geography"))

    def _make_dim_customer_initial(self) -> DataFrame:
        initial = self._before("dim_customer_initial")
        return dims.build_dim_customer_initial(self.sources["customers"], self.dim_geography) if initial is None else initial

    def _make_dim_product(self) -> DataFrame:
        return dims.build_dim_product(self.sources["products"], self.sources["category_translation"], self._before("dim_product"))

    def _make_dim_payment(self) -> DataFrame:
        return dims.build_dim_payment(self.sources["payments"], self._before("dim_payment"))

    def _make_dim_seller(self) -> DataFrame:
        return dims.build_dim_seller(self.sources["sellers"], self.dim_geography, self._before("dim_seller"))

    def _make_dim_date(self) -> DataFrame:
        # one row per day: written once instead of re-deriving min/max from
        # the orders at every use
        return dims.build_dim_date(self.sources["orders"], self._before("dim_date"))

    def _today(self) -> DataFrame:
        return self.customers if self.customers is not None else self.sources.get("customers_snapshot", self.sources["customers"])

    def _make_dim_customer(self) -> DataFrame:
        before = self.previous.dim_customer if self.previous is not None else self.dim_customer_initial
        return next_customers(before, self._today(), self.dim_geography, self.day)[1]

    def _make_snapshot(self) -> DataFrame:
        return scd2.stage_snapshot(self._today(), self.dim_geography, self.day)

    def _make_fact_order_item(self) -> DataFrame:
        return fact.build_fact_order_item(
            self.sources["order_items"],
            self.sources["orders"],
            self.sources["payments"],
            self.dim_customer,
            self.dim_product,
            self.dim_seller,
            self.dim_geography,
            self.dim_date,
            self.dim_payment,
        )

    # The views are not partitioned by year: written straight after a shuffle, every
    # task would write one small file per year, and no report prunes by year.
    # Sorted inside each task (no shuffle) so parquet row-group statistics let
    # pushed-down filters skip row groups: by day here, by status then day for
    # fulfilment (its reports all filter order_status); an order's items, which share
    # most values, lie together.
    def _make_sales(self) -> DataFrame:
        sales = views.sales_view(
            self.fact_order_item, self.dim_date, self.dim_customer, self.dim_geography, self.dim_product, self.dim_seller,
            self.dim_payment)
        return sales.sortWithinPartitions("order_date", "order_id")

    def _make_fulfillment(self) -> DataFrame:
        ful = views.fulfillment_view(
            self.fact_order_item, self.sources["orders"], self.dim_date, self.dim_product, self.dim_seller, self.dim_customer)
        return ful.sortWithinPartitions("order_status", "order_date", "order_id")


def build(
    src: dict[str, DataFrame],
    day: dt.date,
    previous: "Warehouse | None" = None,
    root: str | None = None,
    customers: DataFrame | None = None,
) -> Warehouse:
    """One day's warehouse from source tables (``sources.schemas``). ``customers``:
    the day's customer table (default: ``customers_snapshot`` among the sources, or
    ``customers``, which the first build loads)."""
    return Growing(src, day, previous, root, customers).published()


def run_day(src: dict[str, DataFrame], day: dt.date, root: str, customers: DataFrame | None = None) -> Warehouse:
    """Build a day below ``root`` on what the last earlier day left. A day that was
    built before is built anew from there, so the new attempt replaces the old one
    and no version begins and ends on the same day."""
    spark = src["customers"].sparkSession
    later = [b for b in publish.builds(spark, root) if b.day > day]
    if later:
        raise ValueError(f"{day} can't be built any more: {later[-1].day} stands on it")
    return build(src, day, load(spark, root, before=day), root, customers)


def load(spark: SparkSession, root: str, sources: dict[str, DataFrame] | None = None, before: dt.date | None = None) -> "Warehouse | None":
    """The build below ``root`` published last (of a day before ``before``), None if
    there is none."""
    known = [b for b in publish.builds(spark, root) if before is None or b.day < before]
    if not known:
        return None
    last = known[-1]
    tables = {t: spark.read.parquet(f"{root}/{last.build}/{t}") for t in TABLES}
    return Warehouse(sources=sources or {}, extra={"build": last.build, "day": last.day}, **tables)


def prune(spark: SparkSession, root: str, days: int = 2) -> list[str]:
    """Delete the folders of attempts that were never published, that a later one of
    their day replaced, or whose day is not among the last ``days``; not while a
    build runs. Returns their names."""
    newest = {b.day: b.build for b in publish.builds(spark, root)}
    keep = {newest[d] for d in sorted(newest)[-days:]}
    gone = [f for f in publish.subfolders(spark, root) if f.startswith("build-") and f not in keep]
    for f in gone:
        publish.drop_folder(spark, f"{root}/{f}")
    return gone


VIEW_NAMES = {
    "dim_geography": "dim_geography",
    "dim_customer": "dim_customer",
    "dim_product": "dim_product",
    "dim_payment": "dim_payment",
    "dim_seller": "dim_seller",
    "dim_date": "dim_date",
    "fact_order_item": "fact_order_item",
    "sales": "sales_items",
    "fulfillment": "delivery_items",
}


def register_views(w: Warehouse, prefix: str = "") -> list[str]:
    """Expose the model to SQL users as temp views (``prefix`` plays the role
    of a schema qualifier). Returns the view names."""
    names = []
    for attr, name in VIEW_NAMES.items():
        getattr(w, attr).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    if "orders" in w.sources:
        w.sources["orders"].createOrReplaceTempView(prefix + "orders")
        names.append(prefix + "orders")
    return names


def create_views(spark: SparkSession, root: str, database: str) -> list[str]:
    """Views in the session catalog over the stored tables of the build published
    last below ``root``: every session of the catalog sees them (with a metastore,
    also later ones). Run it after a build has been published; a view never shows
    half a build. Returns their full names."""
    last = publish.builds(spark, root)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for table, view in VIEW_NAMES.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS SELECT * FROM parquet.`{root}/{last.build}/{table}`")
        names.append(f"{database}.{view}")
    return names


_BUILT: dict[tuple[str, str], Growing] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Growing:
    """The warehouse of one data folder, once per Spark application: each table is
    made when it is first read."""
    key = (app_key(spark), sf_dir.rstrip("/"))
    if key not in _BUILT:
        root = f"{checkpoint_root(spark)}/starloom-builds/{uuid.uuid4().hex}"
        w = Growing(adapter.retail_sources(load_tables(spark, sf_dir)), adapter.SNAPSHOT_DATE, None, root, None)
        w.extra["root"] = root
        _BUILT[key] = w
    return _BUILT[key]
