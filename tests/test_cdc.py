"""CDC: payload semantics, deletes, late events, type-1/fact upserts, stream."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import END, OPEN, D, versions
from starloom.operators import cdc_apply, scd2
from starloom.sources.cdc_events import CDC_SCHEMA, ENTITY_ATTRIBUTES
from starloom.streaming import cdc

TS = dt.datetime


def events(spark, rows):
    """rows: (entity, time, op, key, payload_json, event_id)."""
    full = [(e, t, op, k, p, i, i) for e, t, op, k, p, i in rows]
    return spark.createDataFrame(full, CDC_SCHEMA).withColumn("event_date", F.to_date("event_time"))


def geo(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "geography_sk long, zip_code_prefix int")


def obs(spark, rows):
    schema = T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_unique_id", T.StringType()),
        T.StructField("geography_sk", T.LongType()),
        T.StructField("customer_city", T.StringType()),
        T.StructField("customer_state", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("obs_rank", T.LongType()),
    ])
    return spark.createDataFrame(rows, schema)


def customer(spark, ev_rows):
    log = obs(spark, [("a", "u", 1, "c1", "S1", OPEN, 0)])
    dim0 = scd2.timeline(log).withColumn("customer_sk", F.lit(1).cast("long"))
    bronze = events(spark, [("Customer", *r) for r in ev_rows])
    ch = cdc.entity_changes(bronze, "Customer", ENTITY_ATTRIBUTES["Customer"])
    return cdc_apply.customer_scd2_from_events(dim0, log, ch, geo(spark))


def gold_tables(w):
    from starloom.plans import catalog

    return {"order_keys": catalog._order_level(w), "dim_product": w.dim_product, "dim_seller": w.dim_seller, "fact": w.fact_order_item,
            "orders": w.sources["orders"], "payments": w.sources["payments"]}


def current(df):
    return [v for v in versions(df) if v[-1]][0]


def test_partial_payload_keeps_other_attributes(spark):
    out = customer(spark, [(TS(2024, 1, 5, 10), "update", "a", '{"customer_city":"c2"}', 1)])
    assert versions(out) == [
        ("a", "c1", "S1", 1, OPEN, D(2024, 1, 4), False),
        ("a", "c2", "S1", 1, D(2024, 1, 5), END, True),
    ]


def test_explicit_null_overwrites_absent_does_not(spark):
    out = customer(spark, [(TS(2024, 1, 5), "update", "a", '{"customer_state":null}', 1)])
    assert current(out) == ("a", "c1", None, 1, D(2024, 1, 5), END, True)


def test_zip_maps_to_geography(spark):
    out = customer(spark, [(TS(2024, 1, 5), "update", "a", '{"zip_code_prefix":"30"}', 1)])
    assert current(out) == ("a", "c1", "S1", 3, D(2024, 1, 5), END, True)


def test_delete_closes_current_version(spark):
    out = customer(spark, [(TS(2024, 1, 9), "delete", "a", "{}", 1)])
    assert versions(out) == [("a", "c1", "S1", 1, OPEN, D(2024, 1, 8), False)]


def test_late_event_is_placed_by_event_time_and_inherited(spark):
    """A late event (arrives last, happened first) sets the state; the later
    partial event keeps what the late one set."""
    out = customer(spark, [
        (TS(2024, 1, 20), "update", "a", '{"customer_city":"c3"}', 2),
        (TS(2024, 1, 10), "update", "a", '{"customer_state":"S9"}', 3),   # late
    ])
    assert versions(out) == [
        ("a", "c1", "S1", 1, OPEN, D(2024, 1, 9), False),
        ("a", "c1", "S9", 1, D(2024, 1, 10), D(2024, 1, 19), False),
        ("a", "c3", "S9", 1, D(2024, 1, 20), END, True),
    ]


def test_same_day_events_last_wins(spark):
    out = customer(spark, [
        (TS(2024, 1, 10, 9), "update", "a", '{"customer_city":"x"}', 5),
        (TS(2024, 1, 10, 18), "update", "a", '{"customer_city":"y"}', 4),
    ])
    assert current(out) == ("a", "y", "S1", 1, D(2024, 1, 10), END, True)


def test_arrival_order_does_not_matter(spark):
    evs = [
        (TS(2024, 1, 3), "update", "a", '{"customer_city":"p"}', 1),
        (TS(2024, 1, 7), "update", "a", '{"customer_state":"Q"}', 2),
        (TS(2024, 1, 9), "update", "a", '{"customer_city":"c1","customer_state":"S1"}', 3),
    ]
    assert versions(customer(spark, evs)) == versions(customer(spark, list(reversed(evs))))


def test_type1_upsert(spark):
    target = spark.createDataFrame(
        [(1, "p1", "old", 5), (2, "p2", "keep", 6)], "product_sk long, product_id string, cat string, w int"
    )
    bronze = events(spark, [
        ("Product", TS(2024, 1, 2), "update", "p1", '{"cat":"new"}', 1),
        ("Product", TS(2024, 1, 1), "update", "p1", '{"cat":"older","w":"9"}', 2),
        ("Product", TS(2024, 1, 3), "delete", "p2", "{}", 3),
        ("Product", TS(2024, 1, 4), "insert", "p3", '{"cat":"fresh"}', 4),
    ])
    ch = cdc.entity_changes(bronze, "Product", ["cat", "w"])
    out = cdc_apply.current(cdc_apply.type1_upsert(target, ch, "product_id", {"cat": "string", "w": "int"}, sk_col="product_sk"))
    got = sorted((r.product_sk, r.product_id, r.cat, r.w) for r in out.collect())
    assert got == [(1, "p1", "new", 9), (3, "p3", "fresh", None)]


def test_fact_upsert_rewrites_touched_grain_only(spark):
    fact = spark.createDataFrame(
        [("o1", 1, 7, 10.0), ("o1", 2, 7, 20.0)], "order_id string, order_item_id int, customer_sk long, price double"
    ).withColumn("price", F.col("price").cast("decimal(18,2)")).withColumn(
        "freight_value", F.lit(1).cast("decimal(18,2)")
    )
    bronze = events(spark, [("OrderItem", TS(2024, 1, 2), "update", "o1|2", '{"price":"99.50"}', 1),
                            ("OrderItem", TS(2024, 1, 2), "insert", "o9|1", '{"price":"5.00"}', 2)])
    ch = cdc.entity_changes(bronze, "OrderItem", ENTITY_ATTRIBUTES["OrderItem"])
    out = cdc_apply.current(cdc_apply.fact_upsert(fact, ch))
    got = sorted((r.order_id, r.order_item_id, float(r.price), r.customer_sk) for r in out.collect())
    assert got == [("o1", 1, 10.0, 7), ("o1", 2, 99.5, 7), ("o9", 1, 5.0, None)]


def test_silver_keeps_explicit_nulls_and_deletes(spark):
    bronze = events(spark, [
        ("Customer", TS(2024, 1, 1), "update", "a", '{"customer_state":null}', 1),
        ("Customer", TS(2024, 1, 2), "delete", "a", "{}", 2),
        ("Customer", TS(2024, 1, 2), "delete", "a", "{}", 2),   # replayed copy
    ])
    got = sorted((r.event_id, r.attribute, r.value) for r in cdc.silver(bronze).collect())
    assert got == [(1, "customer_state", None), (2, None, None)]


def test_stream_intake_and_foreach_batch_match_batch(spark, tmp_path):
    """JSON files -> availableNow stream in several micro-batches; bronze
    holds every event; foreachBatch sees every event once."""
    from starloom.sources.cdc_events import change_events

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ce = change_events(ev)
    land = str(tmp_path / "landing")
    cdc.land_events(ce, land, files=4)
    cdc.run_bronze(spark, land, str(tmp_path / "bronze"), str(tmp_path / "ck"), max_files_per_trigger=1)
    b = cdc.read_bronze(spark, str(tmp_path / "bronze"))
    assert b.count() == ce.count()
    assert b.select("arrival_seq").distinct().count() == ce.count()
    files = [f for _, _, names in os.walk(tmp_path / "bronze") for f in names if f.endswith(".parquet")]
    assert len(files) <= 4 * b.select("entity_name", "event_date").distinct().count()

    seen = []

    def apply_batch(df, batch_id):
        seen.append((batch_id, df.count()))

    cdc.run_cdc_batches(spark, land, str(tmp_path / "ck2"), apply_batch, max_files_per_trigger=1)
    assert len(seen) == 4 and sum(n for _, n in seen) == ce.count()
    # a second run finds no new files
    cdc.run_bronze(spark, land, str(tmp_path / "bronze"), str(tmp_path / "ck"), max_files_per_trigger=1)
    assert cdc.read_bronze(spark, str(tmp_path / "bronze")).count() == ce.count()


def test_foreach_batch_gold_equals_one_shot_apply(spark, tmp_path):
    """Four micro-batches (events arrive out of order across them) give the
    same gold tables as applying all events at once, while each batch reads
    and rewrites only the bucket/month partitions its keys fall in."""
    from starloom.plans import catalog
    from starloom.plans.warehouse import warehouse
    from starloom.sources.cdc_events import change_events
    from starloom.streaming.gold import CdcGoldApplier

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    land = str(tmp_path / "landing")
    cdc.land_events(change_events(spark.read.parquet(f"{sf}/events.parquet")), land, files=4)
    app = CdcGoldApplier(str(tmp_path / "gold"), w.dim_customer, catalog.customer_log(w), w.dim_geography, gold_tables(w), buckets=16)
    cdc.run_cdc_batches(spark, land, str(tmp_path / "ck"), app, max_files_per_trigger=1)
    assert len(app.batches) == 4

    def strip(df, drop):
        cols = sorted(x for x in df.columns if x not in drop)
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple(map(str, t)))

    assert strip(app.table("dim_customer"), {"customer_sk"}) == strip(
        catalog.q_cdc_customer_scd2(spark, sf), {"customer_sk"})
    assert strip(app.table("dim_product"), {"product_sk"}) == strip(
        catalog.q_cdc_type1_upsert(spark, sf), {"product_sk"})
    assert strip(app.table("dim_seller"), {"seller_sk"}) == strip(
        catalog.q_cdc_type1_upsert_seller(spark, sf), {"seller_sk"})
    inc = catalog.out(app.table("fact"))  # inserted items have the keys of their orders
    assert strip(inc, set()) == strip(catalog.q_cdc_fact_upsert(spark, sf), set())
    # surrogate keys stay unique; existing products keep theirs
    for name, sk in (("dim_customer", "customer_sk"), ("dim_product", "product_sk"), ("dim_seller", "seller_sk")):
        t = app.table(name)
        assert t.select(sk).distinct().count() == t.count()
    kept = app.table("dim_product").join(w.dim_product.select("product_id", F.col("product_sk").alias("o")),
                                         "product_id")
    assert kept.filter("product_sk <> o").count() == 0


def test_monthly_upsert_opens_only_touched_months(spark, tmp_path):
    from starloom.plans import catalog
    from starloom.plans.warehouse import warehouse

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    monthly = cdc_apply.MonthlyFact(spark, str(tmp_path / "fact"), w.dim_date).create(w.fact_order_item)
    before = {p: a for p, a in monthly.parts.at["fact"].items()}
    ch = cdc.entity_changes(catalog.silver_decoded(spark, sf), "OrderItem", ENTITY_ATTRIBUTES["OrderItem"])
    fold = cdc_apply.fold_items(ch)
    orders = [r.order_id for r in fold.join(w.fact_order_item.select("order_id").distinct(), "order_id", "left_semi").select("order_id").distinct().orderBy("order_id").limit(3).collect()]
    fold = fold.filter(F.col("order_id").isin(orders + ["none"]))
    lookups = monthly.parts.tables["order_months"]
    opened = monthly.upsert(None, fold, orders=catalog._level_of(w))

    want = cdc_apply.current(cdc_apply.fact_upsert(w.fact_order_item, None, folded=fold, orders=catalog._level_of(w)))
    key = lambda t: tuple(map(str, t))
    got = sorted(map(tuple, monthly.read().select(*want.columns).collect()), key=key)
    assert got == sorted(map(tuple, want.collect()), key=key)
    dated = w.fact_order_item.join(w.dim_date.select("date_sk", (F.col("year") * 100 + F.col("month")).alias("m")), "date_sk")
    assert opened == [0] + sorted(r.m for r in dated.filter(F.col("order_id").isin(orders)).select("m").distinct().collect())
    after = monthly.parts.at["fact"]
    assert {p for p in after if before.get(p) != after[p]} == {*opened} and len(opened) < len(after)
    again = cdc_apply.MonthlyFact(spark, str(tmp_path / "fact"), w.dim_date)  # another session
    assert again.buckets == monthly.buckets and lookups.keys == ["order_id"]
    assert sorted(map(tuple, again.read().select(*want.columns).collect()), key=key) == got
    # what an upsert reads: the opened months' files of the fact, no others
    files = again.state(opened).inputFiles()
    assert files and {int(f.split("part=")[1].split("/")[0]) for f in files} <= {*opened}
    assert again.upsert(None, fold, orders=catalog._level_of(w)) == opened  # a replay
    assert sorted(map(tuple, again.read().select(*want.columns).collect()), key=key) == got


def test_small_batches_leave_the_fact_unshuffled(spark):
    """The item and payment upserts join the big fact to broadcast keys only."""
    from starloom.plans import catalog
    from starloom.plans.warehouse import warehouse

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    ch = cdc.entity_changes(catalog.silver_decoded(spark, sf), "OrderItem", ENTITY_ATTRIBUTES["OrderItem"])
    touched = cdc_apply.materialize(spark.createDataFrame([("1",)], "order_id string"), "touched")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (cdc_apply.fact_upsert(w.fact_order_item, ch, orders=catalog._level_of(w)),
                    cdc_apply.move_order_keys(w.fact_order_item, touched, catalog._level_of(w))):
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            scans = [line for line in plan.splitlines() if "Join" in line and ("LeftAnti" in line or "LeftSemi" in line)]
            assert scans and all("broadcast" in line for line in scans), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_bad_batch_changes_nothing(spark, tmp_path, monkeypatch):
    """A batch whose result has two current versions, a repeated grain, or that fails
    in its last table leaves every table, its files and the pointer as they were."""
    import hashlib

    from starloom.functions.publish import AuditError
    from starloom.plans import catalog, views
    from starloom.plans.warehouse import warehouse
    from starloom.sources.cdc_events import change_events
    from starloom.streaming import gold

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    tables = {**gold_tables(w), "view_sales": w.sales, "view_fulfillment": w.fulfillment}
    ev = change_events(spark.read.parquet(f"{sf}/events.parquet")).withColumn("event_date", F.to_date("event_time"))
    first, second = ev.filter("arrival_seq % 2 = 0"), ev.filter("arrival_seq % 2 = 1")
    app = gold.CdcGoldApplier(str(tmp_path / "g"), w.dim_customer, catalog.customer_log(w), w.dim_geography, tables, buckets=4, dim_date=w.dim_date)
    app(first, 0)

    def state():
        files = {}
        for folder, _, names in os.walk(tmp_path / "g" / "gold"):
            for name in names:
                files[os.path.join(folder, name)] = hashlib.sha256(open(os.path.join(folder, name), "rb").read()).hexdigest()
        return files, app.parts.at, {n: sorted(map(str, app.table(n).collect())) for n in app.parts.tables}

    before = state()
    twice = lambda rows: rows.unionByName(rows.limit(1))
    broken = [
        (cdc_apply.scd2, "replace_keys", lambda make: lambda *a: (lambda d: d.unionByName(d.filter("current_flag").limit(1).withColumn("effective_date", F.lit(D(2030, 1, 1)))))(make(*a)), AuditError, "second_current"),
        (cdc_apply, "type1_upsert", lambda make: lambda t, ch, keys, *a, **k: twice(make(t, ch, keys, *a, **k)) if "order_item_id" in keys else make(t, ch, keys, *a, **k), AuditError, "repeated_key"),
        (views, "fulfillment_view", lambda make: lambda *a: 1 / 0, ZeroDivisionError, None),
    ]
    for module, name, wrap, error, says in broken:
        with monkeypatch.context() as m:
            m.setattr(module, name, wrap(getattr(module, name)))
            with pytest.raises(error, match=says):
                app(second, 1)
        assert state() == before, name
    app(second, 1)
    assert sorted(map(str, catalog.out(app.table("fact")).select("order_id", "order_item_id", "price", "customer_id", "date_sk").collect())) == sorted(
        map(str, catalog.q_cdc_fact_upsert(spark, sf).select("order_id", "order_item_id", "price", "customer_id", "date_sk").collect()))
    n = app.parts.prune()
    assert n > 0 and app.table("dim_customer").count() == catalog.q_cdc_customer_scd2(spark, sf).count()


def test_replayed_batch_changes_nothing(spark, tmp_path):
    """A micro-batch applied twice (replay after a failure) leaves the gold
    tables as after one application: the summaries merge with max."""
    from starloom.plans import catalog
    from starloom.plans.warehouse import warehouse
    from starloom.sources.cdc_events import change_events
    from starloom.streaming.gold import CdcGoldApplier

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    ev = change_events(spark.read.parquet(f"{sf}/events.parquet")).withColumn("event_date", F.to_date("event_time"))
    app = CdcGoldApplier(str(tmp_path / "g"), w.dim_customer, catalog.customer_log(w), w.dim_geography, gold_tables(w), buckets=8)
    app(ev, 0)
    snap = {n: sorted(map(tuple, app.table(n).collect()), key=lambda t: tuple(map(str, t)))
            for n in ("dim_customer", "dim_product", "fact")}
    app(ev, 0)
    assert app.bronze().count() == ev.count()  # the batch's own folder is replaced
    for n, rows in snap.items():
        assert sorted(map(tuple, app.table(n).collect()), key=lambda t: tuple(map(str, t))) == rows, n


def test_applier_resumes_after_driver_restart(spark, tmp_path):
    """Two batches, then a new applier on the same folder and stream
    checkpoint (a restarted driver) takes two more: the stored state is kept
    and the end result equals a one-shot apply."""
    from starloom.plans import catalog
    from starloom.plans.warehouse import warehouse
    from starloom.sources.cdc_events import change_events
    from starloom.streaming.gold import CdcGoldApplier

    sf = "/root/testdata/sf0.001"
    w = warehouse(spark, sf)
    ce = change_events(spark.read.parquet(f"{sf}/events.parquet"))
    land, ck, root = str(tmp_path / "landing"), str(tmp_path / "ck"), str(tmp_path / "g")

    def applier():
        return CdcGoldApplier(root, w.dim_customer, catalog.customer_log(w), w.dim_geography, gold_tables(w), buckets=8)

    cdc.land_events(ce.filter("arrival_seq % 2 = 0"), land, files=2)
    first = applier()
    cdc.run_cdc_batches(spark, land, ck, first, max_files_per_trigger=1)
    cdc.land_events(ce.filter("arrival_seq % 2 = 1"), land, files=2)
    second = applier()                      # finds the state, does not rebuild it
    assert second.next_sk["customer_sk"] >= first.next_sk["customer_sk"]
    cdc.run_cdc_batches(spark, land, ck, second, max_files_per_trigger=1)
    assert len(first.batches) == 2 and len(second.batches) == 2

    def strip(df, drop):
        cols = sorted(x for x in df.columns if x not in drop)
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple(map(str, t)))

    assert strip(second.table("dim_customer"), {"customer_sk"}) == strip(
        catalog.q_cdc_customer_scd2(spark, sf), {"customer_sk"})
    assert strip(second.table("dim_product"), {"product_sk"}) == strip(
        catalog.q_cdc_type1_upsert(spark, sf), {"product_sk"})
    inc = catalog.out(second.table("fact"))
    assert strip(inc, set()) == strip(catalog.q_cdc_fact_upsert(spark, sf), set())
    t = second.table("dim_customer")
    assert t.select("customer_sk").distinct().count() == t.count()


def test_events_without_id_stay_apart(spark):
    rows = [("Seller", TS(2024, 1, 1), "update", "s1", f'{{"seller_city":"c{i}"}}', None) for i in range(5)]
    bronze = events(spark, rows + rows[:1])  # one of them twice
    assert cdc.dedup_events(bronze).count() == 5
    assert cdc.silver(bronze).count() == 5


def test_faulty_events_are_set_aside(spark):
    t = TS(2024, 1, 1)
    bad = [
        ("Review", t, "update", "1", "{}", 1), (None, t, "update", "1", "{}", 2), ("Seller", t, "update", None, "{}", 3),
        ("OrderItem", t, "update", "o1", "{}", 4), ("Payment", t, "update", "o1|x", "{}", 5), ("Seller", None, "update", "1", "{}", 6),
        ("Seller", t, "merge", "1", "{}", 7), ("Seller", t, "update", "1", "not json", 8),
    ]
    good = [("Seller", t, "delete", "s", None, 9), ("OrderItem", t, "update", "o1|2", '{"price":"1.00"}', 10)]
    bronze = events(spark, bad + good)
    assert sorted(r.event_id for r in cdc.quarantine(bronze).collect()) == list(range(1, 9))
    assert sorted(r.event_id for r in cdc.decoded(bronze).select("event_id").collect()) == [9, 10]
    ch = cdc.entity_changes(bronze, "OrderItem", ENTITY_ATTRIBUTES["OrderItem"])
    assert cdc_apply.fold_items(ch).count() == 1


def test_nothing_returns_after_a_delete(spark):
    target = spark.createDataFrame([(1, "p1", "old", 5)], "product_sk long, product_id string, cat string, w int")
    bronze = events(spark, [("Product", TS(2024, 1, 2), "delete", "p1", "{}", 1), ("Product", TS(2024, 1, 3), "insert", "p1", '{"w":"9"}', 2)])
    ch = cdc.entity_changes(bronze, "Product", ["cat", "w"])
    row = cdc_apply.current(cdc_apply.type1_upsert(target, ch, "product_id", {"cat": "string", "w": "int"}, sk_col="product_sk")).first()
    assert (row.product_sk, row.cat, row.w) == (1, None, 9)
    out = customer(spark, [(TS(2024, 1, 5), "delete", "a", "{}", 1), (TS(2024, 1, 9), "insert", "a", '{"customer_city":"c9"}', 2)])
    assert versions(out) == [("a", "c1", "S1", 1, OPEN, D(2024, 1, 4), False), ("a", "c9", None, None, D(2024, 1, 9), END, True)]


def test_any_split_into_runs_gives_the_same_table(spark):
    target = spark.createDataFrame([(i, f"p{i}", "old", i) for i in range(1, 6)], "product_sk long, product_id string, cat string, w int")
    rng = random.Random(3)
    rows = []
    for i in range(60):
        payload = rng.choice(['{"cat":"c%d"}' % i, '{"w":"%d"}' % i, '{"cat":null}', '{"cat":"x%d","w":"%d"}' % (i, i)])
        op = rng.choice(["update", "update", "insert", "delete"])
        rows.append(("Product", TS(2024, 1, rng.randint(1, 9)), op, f"p{rng.randint(1, 8)}", "{}" if op == "delete" else payload, i))

    def run(parts):
        state = target
        for part in parts:
            ch = cdc.entity_changes(events(spark, part), "Product", ["cat", "w"])
            state = cdc_apply.materialize(cdc_apply.type1_upsert(state, ch, "product_id", {"cat": "string", "w": "int"}), "run")
        return sorted(tuple(r) for r in cdc_apply.current(state).drop("product_sk").select("product_id", "cat", "w", "last_event_time").fillna({"cat": "-", "w": -1}).collect())

    want = run([rows])
    for _ in range(2):
        mixed = rng.sample(rows, len(rows))
        k = rng.randint(1, 58)
        assert run([mixed[:k], mixed[k:], mixed[:5]]) == want


def test_deletes_that_empty_partitions(spark, tmp_path):
    """The last row of a month, of the NULL month and of a bucket goes."""
    from starloom.plans.warehouse import warehouse
    from starloom.streaming.gold import CdcGoldApplier

    fact = spark.createDataFrame([("o1", 1, 1, 10.0), ("o2", 1, 40, 20.0)], "order_id string, order_item_id int, date_sk long, price double")
    fact = fact.withColumns({"price": F.col("price").cast("decimal(18,2)"), "freight_value": F.lit(1).cast("decimal(18,2)")})
    day = spark.createDataFrame([(1, 2024, 1), (40, 2024, 2)], "date_sk long, year int, month int")
    monthly = cdc_apply.MonthlyFact(spark, str(tmp_path / "fact"), day).create(fact)
    steps = [("insert", "o9|1", '{"price":"5.00"}'), ("delete", "o2|1", "{}"), ("delete", "o9|1", "{}"), ("delete", "o1|1", "{}"), ("insert", "o1|1", '{"price":"7.00"}')]
    left = []
    for i, (op, key, payload) in enumerate(steps):
        ch = cdc.entity_changes(events(spark, [("OrderItem", TS(2024, 3, i + 1), op, key, payload, i)]), "OrderItem", ENTITY_ATTRIBUTES["OrderItem"])
        monthly.upsert(ch)
        left.append(sorted((r.order_id, float(r.price)) for r in monthly.read().collect()))
    assert left == [[("o1", 10.0), ("o2", 20.0), ("o9", 5.0)], [("o1", 10.0), ("o9", 5.0)], [("o1", 10.0)], [], [("o1", 7.0)]]

    w = warehouse(spark, "/root/testdata/sf0.001")
    products = w.dim_product.limit(2)
    log = obs(spark, [("a", "u", 1, "c1", "S1", OPEN, 0)])
    dim = scd2.timeline(log).withColumn("customer_sk", F.lit(1).cast("long"))
    app = CdcGoldApplier(str(tmp_path / "g"), dim, log, geo(spark), {"dim_product": products}, buckets=64)
    ids = [r.product_id for r in products.collect()]
    batch = events(spark, [("Product", TS(2024, 1, 1), "delete", i, "{}", n) for n, i in enumerate(ids)]
                   + [("Customer", TS(2024, 1, 2), "insert", "z", '{"customer_city":"c"}', 10)])
    app(batch, 0)
    assert app.table("dim_product").count() == 0 and app.table("dim_customer").filter("customer_id = 'z'").count() == 1
    app(events(spark, [("Customer", TS(2024, 1, 2), "delete", "z", "{}", 11)]), 1)
    assert [r.customer_id for r in app.table("dim_customer").collect()] == ["a"]
