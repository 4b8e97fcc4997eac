"""Gold appliers for decoded CDC events.

* ``customer_scd2_from_events`` (U6): Customer events -> SCD2 customer
  dimension. Touched keys are rebuilt from their whole observation log
  (initial load, snapshots) plus all their events, so a late event lands at
  its event time and later versions inherit what it set. Deletes close the
  current version (no new version); history is never removed.
* ``type1_upsert`` (U7): overwrite attributes by key (product, seller, order).
* ``fact_upsert`` (U8): the same on the fact grain (order_id, order_item_id);
  ``payment_upsert`` on payments, whose primary payment moves the fact's key.

Type-1 targets are *state tables*: next to its attributes a row keeps, per
attribute, the ordering of the event that set it, and the orderings of its last
operation and its last delete; a deleted row stays as a marker. All of these
are maxima, so any split of the events into runs, in any order, gives the same
table. ``current`` is the table without markers and state.

A delete also resets the row: what was set before it does not come back when
the key is inserted again (its surrogate key does, as the key's row is the
same one).

Every step that could meet a hot key is a grouped aggregate with map-side
combine (``max`` over (ordering, value) structs) before any shuffle by key;
the same max merges a stored fold with a new batch, so folds are summaries
that can be kept and updated incrementally;
per-key windows only run after the events are folded to one row per key
and day. Change sets are folded and written once. Target rows of untouched keys
pass through an anti join with the written keys (broadcast if their count is
small, else as Spark sees fit), and only touched rows are joined to anything
else, so the big target is never shuffled to apply a small batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import assign_surrogate_keys
from starloom.functions.publish import Parts, Table, repeated
from starloom.functions.scan import running
from starloom.functions.storage import if_small, materialize
from starloom.operators import scd2
from starloom.operators.dims import geography_lookup, zip_key

c = F.col
KEY = scd2.KEY


def event_order() -> Column:
    """Orders events of one time: by id, or by arrival if an event has none."""
    return F.coalesce(c("event_id"), c("arrival_seq"))


def _ord(time: Column, seq: Column, src: int) -> Column:
    return F.struct(F.lit(src).alias("src"), time.cast("timestamp_ntz").alias("t"), seq.cast("bigint").alias("id"))


# ---------------------------------------------------------------- U6
TRIG = ["geography_sk", "customer_city", "customer_state"]
DAY_STATE = ["op_s", "del_s", "uid_s", "geo_s", "city_s", "state_s"]


def customer_event_rows(changes: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Decoded Customer events as change rows (zip -> geography key)."""
    geo = geography_lookup(dim_geography)
    return changes.join(geo, zip_key("zip_code_prefix") == c("_zip"), "left").select(
        c("primary_key").alias(KEY),
        F.to_date("event_time").alias("day"),
        _ord(c("event_time"), event_order(), 1).alias("ord"),
        c("operation").alias("op"),
        F.lit(False).alias("has_uid"),
        F.lit(None).cast("string").alias("customer_unique_id"),
        c("has_zip_code_prefix").alias("has_geo"),
        "geography_sk",
        "has_customer_city",
        "customer_city",
        "has_customer_state",
        "customer_state",
    )


def observation_rows(log: DataFrame) -> DataFrame:
    """Full-row observations (initial load, snapshots) as change rows that
    carry every attribute, ordered before any event of the same day."""
    return log.select(
        KEY,
        c("obs_date").alias("day"),
        _ord(c("obs_date"), c("obs_rank"), 0).alias("ord"),
        F.lit("snapshot").alias("op"),
        F.lit(True).alias("has_uid"),
        "customer_unique_id",
        F.lit(True).alias("has_geo"),
        "geography_sk",
        F.lit(True).alias("has_customer_city"),
        "customer_city",
        F.lit(True).alias("has_customer_state"),
        "customer_state",
    )


def _latest_struct(value: Column, present: Column) -> Column:
    """max over (ordering, value): the latest present value together with its
    ordering, NULL when no row carried the attribute. An explicit NULL value
    stays a non-NULL struct."""
    return F.max(F.when(present, F.struct(c("ord").alias("ord"), value.alias("v"))))


def fold_customer_days(rows: DataFrame) -> DataFrame:
    """One row per (key, day): per attribute the latest (ordering, value).
    A max per column, so folds merge associatively (``merge_customer_days``)
    and a hot key's events are combined map-side."""
    return rows.groupBy(KEY, "day").agg(
        F.max(F.struct(c("ord").alias("ord"), c("op").alias("v"))).alias("op_s"),
        F.max(F.when(c("op") == "delete", c("ord"))).alias("del_s"),
        _latest_struct(c("customer_unique_id"), c("has_uid")).alias("uid_s"),
        _latest_struct(c("geography_sk"), c("has_geo")).alias("geo_s"),
        _latest_struct(c("customer_city"), c("has_customer_city")).alias("city_s"),
        _latest_struct(c("customer_state"), c("has_customer_state")).alias("state_s"),
    )


def merge_customer_days(*folds: DataFrame) -> DataFrame:
    """Merge day folds (e.g. stored state + a new batch): same max again."""
    u = folds[0]
    for f in folds[1:]:
        u = u.unionByName(f)
    return u.groupBy(KEY, "day").agg(*[F.max(x).alias(x) for x in DAY_STATE])


def versions_from_days(days: DataFrame, hot_days: int = scd2.HOT_DAYS) -> DataFrame:
    """Carry each attribute forward over the days of a key, drop days equal to
    the previous (null-safe, delete state included), close each version the
    day before the next; a delete closes the open version and starts none.
    Nothing is carried across a delete but the person's id, which belongs to
    the key. A key with more than ``hot_days`` days is scanned in segments
    (``functions.scan``), which are spread over tasks."""
    rows, within = scd2.spread(days, [KEY], "day", hot_days)
    rows = rows.withColumn("op_now", c("op_s")["v"])
    sofar = running(rows, within, "day", {x: x for x in DAY_STATE if x != "op_s"})
    last = c("del_s")

    def carried(col: str) -> Column:  # the greatest ordering so far, if no delete came after it
        return F.when(last.isNull() | (c(col)["ord"] > last), c(col)["v"])

    state = sofar.select(
        *within,
        "day",
        (c("op_now") == "delete").alias("deleted"),
        c("uid_s")["v"].alias("customer_unique_id"),
        carried("geo_s").alias("geography_sk"),
        carried("city_s").alias("customer_city"),
        carried("state_s").alias("customer_state"),
    )
    kept = scd2.changes_only(state, within, "day", ["deleted", *TRIG])
    return scd2.closed(kept, within, "day").select(
        KEY,
        "customer_unique_id",
        "geography_sk",
        "customer_city",
        "customer_state",
        c("day").alias("effective_date"),
        "expiry_date",
        "current_flag",
        "deleted",
    ).filter(~c("deleted")).drop("deleted")


def customer_scd2_from_events(
    dim: DataFrame, log: DataFrame, changes: DataFrame, dim_geography: DataFrame, next_sk: int | None = None
) -> DataFrame:
    """``changes`` = ``entity_changes(events, 'Customer', [...])``;
    ``log`` = full-row observations (``scd2.observations``). The events are folded
    and written once; touched keys are rebuilt from their observations and the
    fold, others pass."""
    fold = materialize(fold_customer_days(customer_event_rows(changes, dim_geography)), "cdc-customer-fold")
    touched = materialize(fold.select(KEY).distinct(), "cdc-customer-keys")
    seen = fold_customer_days(observation_rows(log.join(if_small(touched), KEY, "left_semi")))
    return scd2.replace_keys(dim, versions_from_days(merge_customer_days(seen, fold)), if_small(touched), next_sk)


# ---------------------------------------------------------------- U7/U8
OP, DELETED = "_op", "_del"


def _fold(changes: DataFrame, keys: list[str], attributes: dict[str, str]) -> DataFrame:
    """One row per key: last (ordering, operation), the ordering of the last
    delete, and per attribute the latest (ordering, value) of its present
    changes. Max per column, so folds merge with ``merge_folds``."""
    ev = changes.withColumn("ord", _ord(c("event_time"), event_order(), 1))
    aggs = [
        F.max(F.struct(c("ord").alias("ord"), c("operation").alias("v"))).alias(OP),
        F.max(F.when(c("operation") == "delete", c("ord"))).alias(DELETED),
    ]
    for a, typ in attributes.items():
        aggs.append(_latest_struct(c(a).try_cast(typ), c(f"has_{a}")).alias(f"_{a}"))
    return ev.groupBy(*keys).agg(*aggs)


def merge_folds(keys: list[str], *folds: DataFrame) -> DataFrame:
    u = folds[0]
    for f in folds[1:]:
        u = u.unionByName(f)
    return u.groupBy(*keys).agg(*[F.max(x).alias(x) for x in u.columns if x not in keys])


def state_columns(attributes: dict[str, str]) -> list[str]:
    return [OP, DELETED, *(f"_{a}" for a in attributes)]


def with_state(target: DataFrame, attributes: dict[str, str], empty_fold: DataFrame) -> DataFrame:
    """``target`` as a state table; ``empty_fold`` gives the state's types."""
    types = dict(empty_fold.dtypes)
    more = {x: F.lit(None).cast(types[x]) for x in state_columns(attributes) if x not in target.columns}
    if "last_event_time" not in target.columns:
        more["last_event_time"] = F.lit(None).cast("timestamp_ntz")
    return target.withColumns(more) if more else target


def live() -> Column:
    return c(OP).isNull() | (c(OP)["v"] != "delete")


def current(state: DataFrame) -> DataFrame:
    """The rows of a state table that are not deleted, without the state."""
    if OP not in state.columns:
        return state
    return state.filter(live()).select(*[x for x in state.columns if not x.startswith("_")])


def _upsert(target: DataFrame, folded: DataFrame, keys: list[str], attributes: dict[str, str]) -> DataFrame:
    """Touched rows only: state rows (t) FULL OUTER JOIN folded changes (u)."""
    cols = target.columns
    same = [c(f"t.{k}").eqNullSafe(c(f"u.{k}")) for k in keys]
    j = target.alias("t").join(folded.alias("u"), same, "full")
    state = {x: F.greatest(c(f"t.{x}"), c(f"u.{x}")) for x in state_columns(attributes)}
    j = j.select(
        *[F.coalesce(c(f"t.{k}"), c(f"u.{k}")).alias(k) for k in keys],
        *[c(f"t.{x}").alias(x) for x in cols if x not in keys and x not in state],
        *[v.alias(x) for x, v in state.items()],
    )
    out = []
    for col in cols:
        if col in attributes:
            latest = c(f"_{col}")
            reset = c(DELETED).isNotNull() & (latest.isNull() | (latest["ord"] < c(DELETED)))
            out.append(F.when(~reset, F.when(latest.isNotNull(), latest["v"]).otherwise(c(col))).alias(col))
        elif col == "last_event_time":
            out.append(c(OP)["ord"]["t"].alias(col))
        else:
            out.append(c(col))
    return j.select(*out)


def type1_upsert(
    target: DataFrame,
    changes: DataFrame | None,
    keys: str | list[str],
    attributes: dict[str, str],
    sk_col: str | None = None,
    folded: DataFrame | None = None,
    start: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    kept: list[DataFrame] | None = None,
) -> DataFrame:
    """Type-1 overwrite of a state table (a plain table has no state yet): each
    attribute takes its latest present value, a delete marks the row, an
    unknown key is inserted (surrogate key from ``start`` on, by default after
    the largest one). The change set is folded and written once (``folded``: a
    written fold); rows of other keys pass through. ``finish`` is applied to the
    touched rows alone. Returns the state table, or its touched rows alone, with the
    others appended to the list ``kept``."""
    keys = [keys] if isinstance(keys, str) else keys
    if folded is None:
        if keys == [keys[0]] and keys[0] not in changes.columns:
            changes = changes.withColumnRenamed("primary_key", keys[0])
        folded = materialize(_fold(changes, keys, attributes), "cdc-fold")
    target = with_state(target, attributes, folded)
    cond = [c(f"t.{k}").eqNullSafe(c(f"k.{k}")) for k in keys]
    named = if_small(folded.select(*keys))
    touch = lambda how: target.alias("t").join(named.alias("k"), cond, how)
    touched = _upsert(touch("left_semi"), folded, keys, attributes)
    if sk_col:
        touched = materialize(touched, "cdc-touched")
        if start is None:
            start = int(target.agg(F.max(sk_col)).first()[0] or 0) + 1
        new = c(sk_col).isNull() & live()
        keyed = assign_surrogate_keys(touched.filter(new).drop(sk_col), keys, sk_col, start=start)
        touched = touched.filter(~new).unionByName(keyed)
    if finish:
        touched = finish(touched)
    touched = touched.select(*target.columns)
    if kept is not None:
        kept.append(touch("left_anti"))
        return touched
    return touch("left_anti").unionByName(touched)


FACT_KEYS = ["order_id", "order_item_id"]
ITEM_ATTRS = {"price": "decimal(18,2)", "freight_value": "decimal(18,2)", "product_sk": "bigint", "seller_sk": "bigint"}
PAYMENT_KEYS = ["order_id", "payment_sequential"]
PAYMENT_ATTRS = {"payment_type": "string", "payment_installments": "int", "payment_value": "decimal(18,2)"}
ORDER_ATTRS = {"order_status": "string", "order_delivered_customer_date": "timestamp_ntz"}


def split_key(changes: DataFrame, number: str) -> DataFrame:
    """The two parts of an 'order|number' key; what has no number is not a key
    (``cdc.quarantine`` reports it)."""
    parts = F.split("primary_key", r"\|")
    return changes.withColumns({"order_id": F.get(parts, 0), number: F.get(parts, 1).try_cast("int")}).filter(
        c("order_id").isNotNull() & c(number).isNotNull()
    )


def item_changes(changes: DataFrame, dim_product: DataFrame | None = None, dim_seller: DataFrame | None = None) -> DataFrame:
    """OrderItem events by grain; product and seller ids become keys (an id
    that is not known changes nothing)."""
    out = split_key(changes, "order_item_id")
    for dim, key, sk in ((dim_product, "product_id", "product_sk"), (dim_seller, "seller_id", "seller_sk")):
        if dim is None or key not in out.columns:
            out = out.withColumns({f"has_{sk}": F.lit(False), sk: F.lit(None).cast("bigint")})
        else:
            known = dim.select(c(key).alias("_k"), c(sk))
            out = out.join(known, c(key) == c("_k"), "left").drop("_k").withColumn(
                f"has_{sk}", c(f"has_{key}") & c(sk).isNotNull())
    return out


def fold_items(changes: DataFrame, dim_product: DataFrame | None = None, dim_seller: DataFrame | None = None) -> DataFrame:
    return _fold(item_changes(changes, dim_product, dim_seller), FACT_KEYS, ITEM_ATTRS)


ORDER_KEYS = ["customer_id", "customer_sk", "geography_sk", "date_sk", "payment_sk"]


def with_order_keys(fact: DataFrame, orders: DataFrame, only_new: bool = False) -> DataFrame:
    """Fact rows with what each item's order gives it now (rows of
    ``fact.order_level``): keys of items first seen in events, and payment keys
    after payment changes. ``only_new``: leave rows that have a customer as
    they are. For rows that were touched; others need not be joined."""
    own = orders.select(c("order_id").alias("_o"), *[c(x).alias(f"_o_{x}") for x in ORDER_KEYS])
    new = c("customer_id").isNull()
    out = {x: F.when(new, c(f"_o_{x}")).otherwise(c(x)) for x in ORDER_KEYS if x != "payment_sk"}
    out["payment_sk"] = F.when(new | F.lit(not only_new), c("_o_payment_sk")).otherwise(c("payment_sk"))
    joined = fact.join(own, c("order_id") == c("_o"), "left")
    return joined.select(*[out[x].alias(x) if x in out else c(x) for x in fact.columns])


def move_order_keys(fact: DataFrame, touched: DataFrame, level: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The fact after changes to the orders ``touched`` (a written table with
    order_id): ``level(touched)`` gives their order level; the items of other
    orders pass through."""
    named = if_small(touched.select("order_id"))
    return fact.join(named, "order_id", "left_anti").unionByName(
        with_order_keys(fact.join(named, "order_id", "left_semi"), level(named)))


def fact_upsert(
    fact: DataFrame,
    changes: DataFrame | None,
    check_grain: bool = True,
    folded: DataFrame | None = None,
    dim_product: DataFrame | None = None,
    dim_seller: DataFrame | None = None,
    orders: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """MERGE of OrderItem events (or their ``fold_items`` summary) into the
    fact's state table on (order_id, order_item_id). ``orders`` makes the order
    level (``fact.order_level``) of the given orders, which gives inserted grains
    their keys. The grain check (no duplicate grain) runs on the touched grains."""
    if folded is None:
        folded = materialize(fold_items(changes, dim_product, dim_seller), "cdc-item-fold")
    finish = None
    if orders is not None:
        named = if_small(materialize(folded.select("order_id").distinct(), "cdc-item-orders"))
        finish = lambda touched: with_order_keys(touched, orders(named), only_new=True)
    out = type1_upsert(fact, None, FACT_KEYS, ITEM_ATTRS, folded=folded, finish=finish)
    if check_grain:
        scd2.assert_unique(out.select(*FACT_KEYS).join(if_small(folded.select(*FACT_KEYS)), FACT_KEYS, "left_semi"), FACT_KEYS, "fact upsert")
    return out


def payment_upsert(payments: DataFrame, changes: DataFrame) -> DataFrame:
    """Payment events into payments' state table on (order_id, payment_sequential)."""
    return type1_upsert(payments, split_key(changes, "payment_sequential"), PAYMENT_KEYS, PAYMENT_ATTRS)


# ------------------------------------------------- partition-wise publish
NO_MONTH = 0  # of items whose order has no day (yet)
LOOKUP_ROWS = 4_000_000  # orders in a bucket of the lookup


class MonthlyFact:
    """The fact's state table by month of the order day (``Parts`` below ``path``),
    and beside it, by bucket of the order, which month an order's items are in. An
    upsert reads the buckets of its orders, opens the months found there, and
    publishes months and lookup together.

    ``orders`` (optional): makes the order level of given orders, so an inserted
    item gets its order's keys and month at once; an item whose order is not known
    waits in the part without a month, which every upsert opens too."""

    def __init__(self, spark: SparkSession, path: str, dim_date: DataFrame):
        self.parts, self.spark = Parts(spark, path), spark
        self.dim_date = dim_date.select(c("date_sk").alias("_dsk"), (c("year") * 100 + c("month")).cast("int").alias("order_month"))
        self.path = path
        if self.parts.number:
            stored = spark.read.parquet(f"{path}/_settings").first()
            self._declare(T.StructType.fromJson(json.loads(stored.fact)), stored.buckets)

    def _declare(self, fact: T.StructType, buckets: int) -> None:
        self.buckets = buckets
        unique = {"repeated_key": partial(repeated, FACT_KEYS)}
        self.parts.tables["fact"] = Table(T.StructType([f for f in fact.fields if f.name != "order_month"]), FACT_KEYS, c("order_month"), checks=unique)
        lookup = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("order_month", T.IntegerType())])
        self.parts.tables["order_months"] = Table(lookup, ["order_id"], self._bucket(), 1, {"repeated_key": partial(repeated, ["order_id"])})

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def _dated(self, fact: DataFrame) -> DataFrame:
        months = fact.join(self.dim_date, c("date_sk") == c("_dsk"), "left").drop("_dsk")
        return months.withColumn("order_month", F.coalesce("order_month", F.lit(NO_MONTH)))

    def create(self, fact: DataFrame) -> "MonthlyFact":
        """The first content: a plain fact."""
        no_changes = self.spark.createDataFrame([], "primary_key string, event_time timestamp_ntz, event_id long, "
                                                "arrival_seq long, operation string, has_price boolean, price string, "
                                                "has_freight_value boolean, freight_value string")
        state = self._dated(with_state(fact, ITEM_ATTRS, fold_items(no_changes)))
        buckets = max(16, -(-fact.count() // LOOKUP_ROWS))
        self.spark.createDataFrame([(json.dumps(state.schema.jsonValue()), buckets)], "fact string, buckets int").write.mode("overwrite").parquet(f"{self.path}/_settings")
        self._declare(state.schema, buckets)
        self.parts.stage("fact", state)
        self.parts.stage("order_months", self._lookup(self.parts.read("fact")))
        self.parts.publish()
        return self

    def _lookup(self, items: DataFrame) -> DataFrame:
        """(order_id, order_month) of the orders of items that have a day."""
        dated = self._dated(items.select("order_id", "date_sk")).filter(c("order_month") != NO_MONTH)
        return dated.filter("order_id is not null").groupBy("order_id").agg(F.max("order_month").alias("order_month"))

    def upsert(self, changes: DataFrame | None, folded: DataFrame | None = None, orders: Callable[[DataFrame], DataFrame] | None = None) -> list[int]:
        """Merge OrderItem events (or their fold); returns the months opened. State
        rows make a late or replayed batch harmless, a deleted grain stays as a
        marker, and a batch that fails leaves the table as it was."""
        folded = materialize(folded if folded is not None else fold_items(changes), "cdc-item-fold")
        named = if_small(materialize(folded.select("order_id").distinct(), "cdc-item-orders"))
        buckets = sorted(r[0] for r in named.select(self._bucket().alias("b")).distinct().collect())
        known_months = self.parts.read("order_months", buckets)
        months = {r[0] for r in known_months.join(named, "order_id", "left_semi").select("order_month").distinct().collect()}
        new_level = None
        if orders is not None:  # an inserted item may be the first one of its month
            new_level = materialize(orders(named), "cdc-item-order-level")
            months |= {r[0] for r in self._dated(new_level.select("order_id", "date_sk")).select("order_month").distinct().collect()}
        months |= {NO_MONTH}
        finish = (lambda touched: with_order_keys(touched, new_level, only_new=True)) if orders is not None else None
        try:
            merged = type1_upsert(self.parts.read("fact", sorted(months)), None, FACT_KEYS, ITEM_ATTRS, folded=folded, finish=finish)
            self.parts.stage("fact", self._dated(merged), sorted(months))
            fresh = self._lookup(self.parts.read("fact", sorted(months)).join(named, "order_id", "left_semi"))
            both = known_months.unionByName(fresh).groupBy("order_id").agg(F.max("order_month").alias("order_month"))
            self.parts.stage("order_months", both, buckets)
        except Exception:
            self.parts.discard()
            raise
        self.parts.publish()
        return sorted(months)

    def state(self, months: list[int] | None = None) -> DataFrame:
        return self.parts.read("fact", months)

    def read(self, months: list[int] | None = None) -> DataFrame:
        """The fact as it is, or some of its months."""
        return current(self.state(months))
