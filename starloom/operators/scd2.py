"""Customer dimension as SCD Type 2.

* ``stage_snapshot``  (U0)  customers of one day + geography key + date.
* ``merge_source``    (U1a) the reference's MERGE source: every snapshot row
  (force_insert = FALSE) plus the changed rows again (force_insert = TRUE).
* ``apply_snapshot``  (U1)  the MERGE outcome in one pass: current versions
  FULL OUTER JOIN snapshot on the key (one shuffle), 1-2 output rows per key,
  history rows untouched.
* ``version_history`` (U4)  versions of keys in time order.
* ``rebuild_timeline``(U5)  late-arriving observations: re-derive the
  versions of the touched keys from their whole observation log, so event
  time (not arrival time) decides validity.

Change detection follows the reference: ``a <> b OR c <> d OR e <> f``, which
misses a change from or to NULL. ``null_safe=True`` uses IS DISTINCT FROM.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import assign_surrogate_keys
from starloom.functions.scan import RANGE, running, segmented
from starloom.functions.storage import materialize
from starloom.operators.dims import OPEN_END, stage_customers

c = F.col

KEY = "customer_id"
TRIGGERS = ["customer_city", "customer_state", "geography_sk"]
ATTRS = ["customer_unique_id", "geography_sk", "customer_city", "customer_state"]
DIM_COLUMNS = [
    "customer_sk", "customer_id", "customer_unique_id", "geography_sk", "customer_city",
    "customer_state", "effective_date", "expiry_date", "current_flag",
]


def changed(old: str, new: str, null_safe: bool = False, attrs: list[str] = TRIGGERS) -> Column:
    """TRUE when a trigger attribute differs between aliases ``old``/``new``."""
    tests = []
    for a in attrs:
        o, n = c(f"{old}.{a}"), c(f"{new}.{a}")
        tests.append(~o.eqNullSafe(n) if null_safe else F.coalesce(o != n, F.lit(False)))
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def stage_snapshot(
    customers: DataFrame, dim_geography: DataFrame, snapshot_date: dt.date | Column | None = None
) -> DataFrame:
    """Today's customers (or those of ``snapshot_date``) with geography key."""
    if snapshot_date is None:
        d = F.current_date()
    else:
        d = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    return stage_customers(customers, dim_geography).withColumn("snapshot_date", d)


def assert_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Fail with the offending keys if ``keys`` repeat (a MERGE with two source
    rows for one target row is an error). Partial aggregation keeps a hot key
    cheap; only up to 5 offending keys travel to the driver."""
    known = df.filter(reduce(and_, [c(k).isNotNull() for k in keys]))  # a NULL key matches nothing
    dups = known.groupBy(*keys).count().filter(c("count") > 1).limit(5).collect()
    if dups:
        raise ValueError(f"{what}: duplicate keys {[tuple(r[k] for k in keys) for r in dups]}")


def merge_source(staged: DataFrame, dim: DataFrame, null_safe: bool = False) -> DataFrame:
    cols = ["customer_id", "customer_unique_id", "geography_sk", "customer_city", "customer_state", "snapshot_date"]
    cur = dim.filter(c("current_flag") == True)  # noqa: E712  (NULL flag = not current)
    base = staged.select(*cols, F.lit(False).alias("force_insert"))
    forced = (
        staged.alias("s")
        .join(cur.alias("t"), c(f"s.{KEY}") == c(f"t.{KEY}"))
        .filter(changed("t", "s", null_safe))
        .select(*[c(f"s.{x}") for x in cols], F.lit(True).alias("force_insert"))
    )
    return base.unionByName(forced)


def _max_sk(dim: DataFrame) -> int:
    v = dim.agg(F.max("customer_sk")).first()[0]
    return int(v or 0)


def _number_new(rows: DataFrame, dim: DataFrame, next_sk: int | None = None) -> DataFrame:
    """Key new versions after the largest existing key (or from ``next_sk``
    when the caller holds only part of the dimension), in (id, date) order."""
    fresh = rows.filter(c("customer_sk").isNull()).drop("customer_sk")
    start = next_sk if next_sk is not None else _max_sk(dim) + 1
    keyed = assign_surrogate_keys(fresh, [KEY, "effective_date"], "customer_sk", start=start)
    return rows.filter(c("customer_sk").isNotNull()).unionByName(keyed.select(*DIM_COLUMNS))


def apply_snapshot(
    dim: DataFrame,
    staged: DataFrame,
    null_safe: bool = False,
    check_unique: bool = True,
) -> DataFrame:
    """Result of the reference MERGE for one staged snapshot.

    changed key -> current version expires at snapshot-1, new version from
    the snapshot date to 9999-12-31; key without a current version -> new
    version; unchanged or absent keys and all history -> untouched. The
    non-trigger attribute customer_unique_id of a matched version is never
    updated."""
    if check_unique:
        assert_unique(staged, [KEY], "snapshot")
    is_cur = c("current_flag") == True  # noqa: E712
    cur = dim.filter(is_cur)
    history = dim.filter(~F.coalesce(is_cur, F.lit(False)))

    # a marker per side tells presence, so rows with a NULL key are kept (they
    # match nothing, as in a MERGE: the stored one stays, the staged one is inserted)
    t = cur.withColumn("_t", F.lit(True)).alias("t")
    j = t.join(staged.withColumn("_s", F.lit(True)).alias("s"), c(f"t.{KEY}") == c(f"s.{KEY}"), "full")
    has_t, has_s = c("t._t").isNotNull(), c("s._s").isNotNull()
    chg = has_t & has_s & changed("t", "s", null_safe)
    old_row = F.struct(
        c("t.customer_sk").alias("customer_sk"),
        c(f"t.{KEY}").alias(KEY),
        *[c(f"t.{a}").alias(a) for a in ATTRS],
        c("t.effective_date").alias("effective_date"),
        F.when(chg, F.date_sub(c("s.snapshot_date"), 1)).otherwise(c("t.expiry_date")).alias("expiry_date"),
        F.when(chg, F.lit(False)).otherwise(c("t.current_flag")).alias("current_flag"),
    )
    new_row = F.struct(
        F.lit(None).cast("bigint").alias("customer_sk"),
        c(f"s.{KEY}").alias(KEY),
        *[c(f"s.{a}").alias(a) for a in ATTRS],
        c("s.snapshot_date").alias("effective_date"),
        F.lit(OPEN_END).alias("expiry_date"),
        F.lit(True).alias("current_flag"),
    )
    rows = F.array(F.when(has_t, old_row), F.when(has_s & (~has_t | chg), new_row))
    merged = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    merged = materialize(merged, "scd2-merged")
    return history.select(*DIM_COLUMNS).unionByName(_number_new(merged, dim))


def version_history(dim: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Versions of ``keys`` (default: every key with more than one version),
    ordered by key and effective date."""
    if keys is None:
        keys = dim.groupBy(KEY).count().filter(c("count") > 1).select(KEY)
    return (
        dim.join(keys.select(KEY), KEY, "left_semi")
        .select(KEY, "customer_city", "customer_state", "effective_date", "expiry_date", "current_flag")
        .orderBy(KEY, "effective_date")
    )


OBS_COLUMNS = [KEY, *ATTRS, "obs_date", "obs_rank"]


def observations(staged: DataFrame, obs_date: dt.date | Column, rank: int | Column) -> DataFrame:
    """Full-row observations of customers at a date (a snapshot, the initial
    load, or decoded events); ``obs_rank`` orders observations of one day."""
    d = obs_date if isinstance(obs_date, Column) else F.lit(obs_date)
    r = rank if isinstance(rank, Column) else F.lit(rank)
    return staged.select(KEY, *ATTRS, d.cast("date").alias("obs_date"), r.cast("bigint").alias("obs_rank"))


#: Days of one key that one task takes in order; beyond it, all keys are scanned in
#: segments. Either way gives the same rows.
HOT_DAYS = 100_000


def spread(rows: DataFrame, keys: list[str], order: str, hot: int = HOT_DAYS) -> tuple[DataFrame, list[str]]:
    """``rows`` (one a key and ``order``), written, and the columns a window over
    them goes by: the keys, or, if a key has more than ``hot`` rows, segments of
    them (``functions.scan``)."""
    rows = materialize(rows, "timeline-days")
    most = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return (rows, keys) if most <= hot else (segmented(rows, keys, order), [RANGE, *keys])


def changes_only(rows: DataFrame, within: list[str], order: str, attrs: list[str]) -> DataFrame:
    """Rows that differ (null-safe) from the key's row before them."""
    before = running(rows, within, order, {"_before": F.struct(c(order), *[c(a) for a in attrs])}, inclusive=False)
    same = reduce(and_, [c("_before")[a].eqNullSafe(c(a)) for a in attrs])
    return before.filter(c("_before").isNull() | ~same).drop("_before")


def closed(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    """Versions that begin on ``order``: each one ends the day before the next."""
    after = running(rows, within, order, {"_next": order}, inclusive=False, following=True)
    return after.withColumns({
        "expiry_date": F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END)), "current_flag": c("_next").isNull(),
    }).drop("_next")


def timeline(obs: DataFrame, hot_days: int = HOT_DAYS) -> DataFrame:
    """Versions from observations: the last observation of each (key, day)
    wins, a day equal to the previous one (null-safe) adds no version, and a
    version ends the day before the next begins.

    The per-day pick is a grouped max over a struct (partial aggregation, so
    a key with many events on one day is combined map-side). What follows sees
    at most one row per key and day, and spreads a key with very many days."""
    last = obs.groupBy(KEY, "obs_date").agg(
        F.max(F.struct(c("obs_rank"), *[c(a) for a in ATTRS])).alias("o")
    )
    day = last.select(KEY, c("obs_date").alias("effective_date"), *[c(f"o.{a}").alias(a) for a in ATTRS])
    days, within = spread(day, [KEY], "effective_date", hot_days)
    versions = closed(changes_only(days, within, "effective_date", TRIGGERS), within, "effective_date")
    return versions.select(
        F.lit(None).cast("bigint").alias("customer_sk"), KEY, *ATTRS, "effective_date", "expiry_date", "current_flag",
    )


def replace_keys(dim: DataFrame, versions: DataFrame, touched: DataFrame, next_sk: int | None = None) -> DataFrame:
    """Swap the versions of ``touched`` keys for ``versions``. A version whose
    (key, effective_date) existed keeps its surrogate key; others get new
    keys after the largest one (or from ``next_sk``). Versions of other keys
    pass unchanged."""
    old_keys = (
        dim.join(touched, KEY, "left_semi")  # only the touched keys' versions matter
        .groupBy(KEY, "effective_date")
        .agg(F.max("customer_sk").alias("customer_sk"))
    )
    rebuilt = versions.drop("customer_sk").join(old_keys, [KEY, "effective_date"], "left").select(*DIM_COLUMNS)
    rebuilt = materialize(rebuilt, "scd2-rebuilt")
    untouched = dim.join(touched, KEY, "left_anti").select(*DIM_COLUMNS)
    return untouched.unionByName(_number_new(rebuilt, dim, next_sk))


def rebuild_timeline(dim: DataFrame, log: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Insert late-arriving observations (U5).

    Keys in ``arrivals`` are rebuilt from their whole observation log plus
    the arrivals (never from stored versions alone: a stored version cannot
    tell a carried-over value from an observed one). Other keys keep their
    versions. A rebuilt version that existed before keeps its surrogate key.
    """
    touched = arrivals.select(KEY).distinct()
    obs = log.select(*OBS_COLUMNS).unionByName(arrivals.select(*OBS_COLUMNS)).join(touched, KEY, "left_semi")
    return replace_keys(dim, timeline(obs), touched)
