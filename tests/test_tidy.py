"""What is written on the way to a result goes when the result is there, and tables
are made when they are asked for."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import rows
from starloom.functions import publish, storage
from starloom.plans import catalog
from starloom.plans import warehouse as W
from starloom.sources import adapter
from starloom.sources.tables import load_tables
from starloom.streaming import cdc


def test_temporary_tables_are_deleted(spark):
    before = storage.materialize(spark.range(3), "before")
    with storage.temporary(spark):
        made = storage.materialize(spark.range(5), "made")
        path = made.inputFiles()[0].removeprefix("file:")
        with storage.temporary(spark):
            inner = storage.materialize(made, "inner").inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path) and not os.path.exists(inner)
    assert not os.path.exists(os.path.dirname(path)) and before.count() == 3


def test_writes_drop_their_shuffles(spark, tmp_path):
    assert spark.conf.get(storage.TIDY, None) in (None, "false")
    was = spark.conf.get(storage.TIDY, None)
    with pytest.raises(ZeroDivisionError), storage.shuffles_dropped(spark), storage.shuffles_dropped(spark.range(1).sparkSession):
        assert spark.conf.get(storage.TIDY) == "true"
        1 / 0
    assert spark.conf.get(storage.TIDY, None) == was
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in local for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = files()
    out = storage.write_table(spark.range(1000).repartition(4, "id"), str(tmp_path / "t"))
    for _ in range(50):  # the block managers delete them on their own time
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and out.count() == 1000


def test_publish_keeps_the_content_it_replaces_and_no_older(spark, tmp_path):
    p = publish.Parts(spark, str(tmp_path / "p"))
    df = lambda v: spark.range(10).withColumn("v", F.lit(v))
    p.tables["t"] = publish.Table(df(0).schema, ["id"], F.pmod("id", F.lit(2)), 1)
    readers = []
    for v in range(4):
        p.stage("t", df(v))
        p.publish()
        readers.append(p.read("t"))
    assert len(publish.subfolders(spark, str(tmp_path / "p" / "t"))) == 2
    assert {r.v for r in readers[3].collect()} == {3} and {r.v for r in readers[2].collect()} == {2}


def test_tables_are_made_when_they_are_asked_for(spark, tmp_path):
    w = W.Growing(adapter.retail_sources(load_tables(spark, SF_SMALL)), adapter.SNAPSHOT_DATE, None, str(tmp_path), None)
    customers = rows(w.dim_customer)
    assert "fact_order_item" not in w.__dict__ and "order_items" not in w.sources and W.load(spark, str(tmp_path)) is None
    whole = W.build(adapter.retail_sources(load_tables(spark, SF_SMALL)), adapter.SNAPSHOT_DATE, root=str(tmp_path / "b"))
    for table in ("sales", "fulfillment"):
        assert sorted(map(str, getattr(w, table).collect())) == sorted(map(str, getattr(whole, table).collect()))
    w.published().published()
    stored = W.load(spark, str(tmp_path))
    assert sorted(rows(stored.dim_customer)) == sorted(customers) and len(publish.builds(spark, str(tmp_path))) == 1
    with pytest.raises(AttributeError):
        w.no_such_table


def test_queries_over_events_make_no_warehouse(spark, monkeypatch):
    monkeypatch.setattr(W, "_BUILT", {})
    monkeypatch.setattr(catalog, "_KEPT", {})
    assert catalog.q_cdc_bronze_compacted(spark, SF_SMALL).count() == load_tables(spark, SF_SMALL)["events"].count()
    assert not W._BUILT


def lines(spark):
    """Order 1 with many lines, some twice; order 2 with few; one without an order."""
    make = [(1, i % 40, i % 7, i % 3, 1 + i % 4, float(i % 5), 10.0 * (i % 9), 0.1, 0.02, "A", "F") for i in range(120)]
    make += [(2, 5, 1, 1, 2, 1.0, 9.5, 0.0, 0.0, None, "O"), (2, 4, 1, 1, None, 1.0, 9.5, 0.0, 0.0, "N", "O"), (None, 4, 1, 1, 1, 1.0, 9.5, 0.0, 0.0, "N", "O")]
    names = ["l_orderkey", "l_partkey", "l_suppkey", "n", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    types = "l_orderkey long, l_partkey long, l_suppkey long, n int, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    assert len(names) == len(make[0])
    df = spark.createDataFrame(make, types)
    return {"lineitem": df.withColumn("l_shipdate", F.expr("timestamp_ntz'1998-01-01' + make_dt_interval(n)")).drop("n")}


def test_an_order_with_many_lines_is_numbered_like_any_other(spark):
    t = lines(spark)
    assert [r.l_orderkey for r in adapter.orders_with_many_lines(t["lineitem"], 100).collect()] == [1]
    cols = ["l_orderkey", *adapter.ITEM_ORDER, "item_no"]
    by_window, by_rank = (sorted(map(str, adapter.order_lines(t, hot).select(*cols).collect())) for hot in (1000, 100))
    assert by_window == by_rank and len(by_window) == 122


def test_numbering_few_lines_takes_one_shuffle(spark):
    plan = adapter.order_lines(lines(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 1 and "Join" not in plan


def test_landed_files_are_compressed(spark, tmp_path):
    cdc.land_events(cdc_events(spark), str(tmp_path / "landing"), files=1)
    names = glob.glob(str(tmp_path / "landing" / "part-*"))
    assert names and all(n.endswith(".json.gz") for n in names)


def cdc_events(spark):
    from starloom.sources.cdc_events import change_events

    return change_events(load_tables(spark, SF_SMALL)["events"])
