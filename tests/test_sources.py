"""Raw files into the build: rejects are set aside, good rows make the warehouse."""

import json

from conftest import SF_SMALL
from starloom.plans import warehouse as W
from starloom.sources import adapter, schemas


def test_broken_records_of_csv_and_json(spark, tmp_path):
    (tmp_path / "sellers").mkdir()
    (tmp_path / "sellers" / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,10,c,S\ns2,ten,c,S\ns3,1\ns4,1,c,S,x\n,,,\n")
    rows, rejects = schemas.land_source(spark, "sellers", str(tmp_path / "sellers"))
    assert sorted(map(tuple, rows.collect()), key=str) == [("s1", 10, "c", "S"), (None, None, None, None)]
    got = rejects.orderBy("record").collect()
    assert [r.record for r in got] == ["s2,ten,c,S", "s3,1", "s4,1,c,S,x"] and {(r.table_name, r.source_file) for r in got} == {("sellers", "a.csv")}
    assert rejects.count() == 3 and rows.select("seller_id").count() == 2  # whatever columns are read
    (tmp_path / "orders").mkdir()
    good = {"order_id": "o", "customer_id": "c", "order_purchase_timestamp": "2020-01-02T03:04:05"}
    (tmp_path / "orders" / "b.json").write_text(json.dumps(good) + "\n{broken\n" + json.dumps({**good, "order_approved_at": "never"}) + "\n")
    rows, rejects = schemas.land_source(spark, "orders", str(tmp_path / "orders"), "json")
    assert [r.order_id for r in rows.collect()] == ["o"] and rejects.count() == 2


def test_the_build_runs_on_csv_files(spark, tmp_path):
    w = W.warehouse(spark, SF_SMALL)
    adapter.export_csv(w.sources, str(tmp_path / "raw"))
    src, rejects = schemas.land_sources(spark, str(tmp_path / "raw"), header="false", **adapter.CSV_OPTIONS)
    assert rejects.count() > 0
    again = W.run_day(src, adapter.SNAPSHOT_DATE, str(tmp_path / "wh"), customers=w.sources["customers_snapshot"])
    for name in ("dim_geography", "dim_product", "dim_seller", "dim_payment", "dim_date", "dim_customer", "fact_order_item", "sales", "fulfillment"):
        a, b = getattr(w, name), getattr(again, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())), name
