"""Daily builds: history and keys live on; tables are read back by name."""

import datetime as dt
import shutil

import pytest
from conftest import SF_SMALL
from helpers import END, OPEN, D, dim, snap, versions
from pyspark.sql import functions as F
from starloom.functions.publish import AuditError
from starloom.operators import dims, scd2
from starloom.plans import warehouse as W
from starloom.sources import adapter
from starloom.sources.tables import load_tables


def rows(df):
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}


MODEL = ("dim_geography", "dim_customer_initial", "dim_product", "dim_seller", "dim_payment", "dim_date", "dim_customer", "fact_order_item", "sales", "fulfillment")


def model(w):
    return {name: rows(getattr(w, name)) for name in MODEL}


@pytest.fixture(scope="module")
def src(spark):
    return adapter.retail_sources(load_tables(spark, SF_SMALL))


@pytest.fixture(scope="module")
def first_day(spark, src, tmp_path_factory):
    """A root with one published day; tests work on copies of it."""
    root = str(tmp_path_factory.mktemp("wh") / "wh")
    return root, model(W.run_day(src, adapter.SNAPSHOT_DATE, root))


@pytest.fixture
def root(first_day, tmp_path):
    return shutil.copytree(first_day[0], str(tmp_path / "wh"))


def test_three_days_keep_all_history_and_keys(spark, src, root):
    assert W.load(spark, f"{root}-none") is None
    before, days = W.load(spark, root), adapter.customers_next_days(load_tables(spark, SF_SMALL))
    for day, customers in days:
        stored = W.load(spark, root)  # what another session would read
        assert rows(stored.dim_customer) == rows(before.dim_customer)
        after = W.run_day(src, day, root, customers)
        old = {r.customer_sk: r for r in stored.dim_customer.collect()}
        new = {r.customer_sk: r for r in after.dim_customer.collect()}
        assert set(old) < set(new) and len(new) == after.dim_customer.count()
        for sk, r in old.items():  # a version keeps its meaning; only its end may change, once
            n = new[sk]
            assert (n.customer_id, n.effective_date, n.customer_city, n.customer_state) == (r.customer_id, r.effective_date, r.customer_city, r.customer_state)
            assert n.expiry_date == r.expiry_date or (r.current_flag and n.expiry_date == day - dt.timedelta(days=1) and not n.current_flag)
        for name in ("dim_product", "dim_seller", "dim_payment", "dim_geography", "dim_date", "dim_customer_initial"):
            assert rows(getattr(after, name)) == rows(getattr(stored, name)), name
        before = after
    assert W.load(spark, root).extra["day"] == days[-1][0]
    assert len(W.prune(spark, root)) == 1 and rows(W.load(spark, root).dim_customer) == rows(before.dim_customer)
    with pytest.raises(ValueError, match="stands on it"):
        W.run_day(src, days[0][0], root)


def test_the_same_day_again(spark, src, root, first_day):
    """A rerun reads what it replaces, and changes nothing."""
    stored = W.load(spark, root)
    W.run_day(src, adapter.SNAPSHOT_DATE, root)
    again = W.load(spark, root)
    assert again.extra["build"] != stored.extra["build"]
    assert model(again) == first_day[1] == model(stored)
    on_itself = W.build(src, adapter.SNAPSHOT_DATE, previous=again, root=root)  # the day's own build as the one before
    assert model(on_itself) == first_day[1] == model(W.load(spark, root))
    W.prune(spark, root)
    assert model(W.load(spark, root)) == first_day[1]


def test_a_corrected_day_leaves_no_empty_versions(spark, src, root):
    day, customers = adapter.customers_next_days(load_tables(spark, SF_SMALL))[0]
    W.run_day(src, day, root, customers.withColumn("customer_state", F.lit("WRONG")))
    fixed = rows(W.run_day(src, day, root, customers).dim_customer)
    assert fixed == rows(W.load(spark, root).dim_customer)
    assert not any("WRONG" in r for r in fixed)
    assert W.load(spark, root).dim_customer.filter("expiry_date < effective_date").count() == 0


@pytest.mark.parametrize("table", ["dim_date", "fact_order_item", "snapshot"])
def test_a_build_killed_half_way_changes_nothing(spark, src, root, first_day, monkeypatch, table):
    write = W.write_table

    def killed(df, path, *more):
        out = write(df, path, *more)
        if path.endswith(f"/{table}"):
            raise RuntimeError("killed")
        return out

    monkeypatch.setattr(W, "write_table", killed)
    with pytest.raises(RuntimeError):
        W.run_day(src, adapter.SNAPSHOT_DATE, root)
    monkeypatch.undo()
    assert model(W.load(spark, root)) == first_day[1]
    assert len(W.prune(spark, root)) == 1


def test_a_bad_table_is_not_published(spark, src, root, first_day, monkeypatch):
    monkeypatch.setattr(W.fact, "build_fact_order_item", lambda *a, make=W.fact.build_fact_order_item: (lambda f: f.unionByName(f.limit(3)))(make(*a)))
    with pytest.raises(AuditError, match="fact_order_item"):
        W.run_day(src, adapter.SNAPSHOT_DATE, root)
    monkeypatch.undo()
    monkeypatch.setattr(W, "next_customers", lambda dim, *a, make=W.next_customers: (lambda staged, d: (staged, d.unionByName(d.filter("current_flag").limit(2))))(*make(dim, *a)))
    with pytest.raises(AuditError, match="dim_customer"):
        W.run_day(src, adapter.SNAPSHOT_DATE, root)
    assert model(W.load(spark, root)) == first_day[1]


def test_null_keys_are_not_lost(spark):
    stored = dim(spark, [(1, "a", "u", 1, "c", "S", OPEN, END, True), (2, None, "u", 1, "c", "S", OPEN, END, True)])
    day = snap(spark, [("a", "u", 1, "c", "T", D(2020, 1, 1)), (None, "v", 1, "d", "S", D(2020, 1, 1))])
    out = scd2.apply_snapshot(stored, day)
    assert versions(out) == [
        (None, "c", "S", 1, OPEN, END, True),
        (None, "d", "S", 1, D(2020, 1, 1), END, True),
        ("a", "c", "S", 1, OPEN, D(2019, 12, 31), False),
        ("a", "c", "T", 1, D(2020, 1, 1), END, True),
    ]


def test_calendar_goes_on_from_its_first_day(spark):
    make = lambda *days: spark.createDataFrame([(d,) for d in days], "order_purchase_timestamp timestamp_ntz")
    first = dims.build_dim_date(make(dt.datetime(2020, 1, 10), dt.datetime(2020, 1, 12)))
    later = dims.build_dim_date(make(dt.datetime(2020, 1, 9), dt.datetime(2020, 1, 13)), first)
    assert sorted((r.date_sk, r.calendar_date.day) for r in later.collect()) == [(0, 9), (1, 10), (2, 11), (3, 12), (4, 13)]


def test_appends_by_name(spark, tmp_path):
    from starloom.functions.storage import append

    path = str(tmp_path / "t")
    append(spark.createDataFrame([(1, "a")], "k int, x string"), path)
    append(spark.createDataFrame([("b", 2.5, 2)], "x string, y double, k int"), path)  # a new column, another order
    out = append(spark.createDataFrame([(3,)], "k int"), path)
    assert sorted((r.k, r.x, r.y) for r in out.collect()) == [(1, "a", None), (2, "b", 2.5), (3, None, None)]
