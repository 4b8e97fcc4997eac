"""The reference's scripted SCD2 check: five customers (ordered LIMIT 5) move
to 'simulated_city'/'SC' in a snapshot dated the next day; the merge is run on
a copy of the dimension and the version history of those five is read."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import END, OPEN
from starloom.operators import dims, scd2
from starloom.plans.warehouse import warehouse

D = dt.date(2030, 6, 2)


def test_simulated_change_history(spark):
    w = warehouse(spark, SF_SMALL)
    dim0 = w.dim_customer_initial
    picked = [r.customer_id for r in dim0.select("customer_id").orderBy("customer_id").limit(5).collect()]
    hit = F.col("customer_id").isin(picked)
    customers = w.sources["customers"].select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        F.when(hit, "simulated_city").otherwise(F.col("customer_city")).alias("customer_city"),
        F.when(hit, "SC").otherwise(F.col("customer_state")).alias("customer_state"),
    )
    staged = scd2.stage_snapshot(customers, w.dim_geography, F.date_add(F.lit(D - dt.timedelta(days=1)), 1))
    copy = dim0  # DataFrames are immutable: the "copy" is the same input
    out = scd2.apply_snapshot(copy, staged)

    keys = spark.createDataFrame([(i,) for i in picked], "customer_id string")
    hist = scd2.version_history(out, keys).collect()
    old = {r.customer_id: r for r in dim0.collect() if r.customer_id in picked}
    want = []
    for i in sorted(picked):
        want.append((i, old[i].customer_city, old[i].customer_state, OPEN, D - dt.timedelta(days=1), False))
        want.append((i, "simulated_city", "SC", D, END, True))
    assert [tuple(r) for r in hist] == want
    assert out.count() == dim0.count() + 5
    assert scd2.apply_snapshot(out, staged).count() == out.count()   # rerun: no change


def test_snapshot_date_defaults_to_today(spark):
    w = warehouse(spark, SF_SMALL)
    staged = scd2.stage_snapshot(w.sources["customers"], w.dim_geography)
    assert staged.select(F.max("snapshot_date") == F.current_date()).first()[0]


def test_typed_source_reader(spark, tmp_path):
    from starloom.sources.schemas import read_source

    p = tmp_path / "orders.csv"
    p.write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,"
        "2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,shipped,2018-01-01 00:00:00,,,,2018-01-20 00:00:00\n"
    )
    df = read_source(spark, "orders", str(p), fmt="csv")
    assert dict(df.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    rows = sorted(df.collect())
    assert rows[0].order_delivered_customer_date == dt.datetime(2017, 10, 10, 21, 25, 13)
    assert rows[1].order_approved_at is None
    d = dims.build_dim_date(df).collect()
    assert len(d) == (dt.date(2018, 1, 1) - dt.date(2017, 10, 2)).days + 1
