"""Parts of tables: one pointer, checked while written."""

import os

import pytest
from pyspark.sql import functions as F
from starloom.functions import publish
from starloom.streaming import cdc
from test_cdc import TS, events


def parts(spark, root):
    p = publish.Parts(spark, root)
    schema = spark.createDataFrame([], "k long, v string").schema
    for name in ("a", "b"):
        p.tables[name] = publish.Table(schema, ["k"], F.col("k") % 4, 2, {"repeated_key": lambda within: publish.repeated(["k"], within)}, ("k",))
    return p


def rows(spark, *pairs):
    return spark.createDataFrame([*pairs], "k long, v string")


def content(p, name):
    return sorted((r.k, r.v) for r in p.read(name).collect())


def test_parts_change_together(spark, tmp_path):
    root = str(tmp_path / "t")
    p = parts(spark, root)
    assert content(p, "a") == []
    assert p.stage("a", rows(spark, *[(k, "old") for k in range(8)])) == {"rows": 8, "repeated_key": 0, "k": 7}
    p.stage("b", rows(spark, (1, "b"), (None, "c")).na.fill(2))
    assert content(parts(spark, root), "a") == []  # staged, not published
    p.publish()
    assert content(parts(spark, root), "a") == [(k, "old") for k in range(8)]
    p.stage("a", rows(spark, (1, "new")), [1])
    p.stage("b", rows(spark), [2])
    assert content(p, "a") == [(0, "old"), (1, "new"), (2, "old"), (3, "old"), (4, "old"), (6, "old"), (7, "old")]
    assert len(content(parts(spark, root), "a")) == 8 and len(content(parts(spark, root), "b")) == 2
    p.publish()
    assert content(parts(spark, root), "a") == content(p, "a") and content(parts(spark, root), "b") == [(1, "b")]
    p.stage("a", rows(spark, (1, "third")), [1])
    p.discard()
    assert content(p, "a")[1] == (1, "new")
    assert {f.split("part=")[1][0] for f in p.read("a", [1, 3]).inputFiles()} == {"1", "3"}
    gone = p.prune()
    assert gone >= 1 and content(parts(spark, root), "a") == content(p, "a")


def test_violations_and_strays_are_not_staged(spark, tmp_path):
    p = parts(spark, str(tmp_path / "t"))
    with pytest.raises(publish.AuditError) as e:
        p.stage("a", rows(spark, (1, "x"), (1, "y"), (2, "z")))
    assert e.value.counts == {"rows": 3, "repeated_key": 1}
    with pytest.raises(publish.AuditError) as e:
        p.stage("a", rows(spark, (1, "x"), (2, "z")), [1])
    assert e.value.counts["in_another_part"] == 1
    p.discard()
    assert content(p, "a") == [] and not [f for f in os.listdir(tmp_path / "t" / "a") if not f.startswith(".")]


def test_nulls_in_keys_are_no_violation(spark):
    df = rows(spark, (None, "x"), (None, "y"), (1, "x"))
    assert df.filter(F.lit(True)).withColumn("bad", publish.repeated(["k"])).filter("bad").count() == 0
    versions = spark.createDataFrame([("a", "2020-01-01", True), ("a", "2021-01-01", True), ("b", "2020-01-01", None), ("b", "2021-01-01", True), (None, "2020-01-01", True), (None, "2020-01-01", True)],
                                     "customer_id string, effective_date string, current_flag boolean")
    assert [r.customer_id for r in versions.withColumn("bad", publish.second_current()).filter("bad").collect()] == ["a"]


def test_many_small_files_are_packed(spark, tmp_path):
    """50 micro-batches on two days; packing bounds a day's files by its bytes."""
    land, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    make = lambda n: events(spark, [("Seller", TS(2024, 1, 1 + n % 2, 0, i), "update", f"s{i}", '{"seller_city":"c"}', 1000 * n + i) for i in range(4)]).drop("event_date")
    for n in range(50):
        cdc.land_events(make(n), land, files=1)
    cdc.run_bronze(spark, land, bronze, str(tmp_path / "ck"), max_files_per_trigger=1)
    plain = sorted(map(str, cdc.read_bronze(spark, bronze).collect()))
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(bronze) for f in names if f.endswith(".parquet")]
    assert len(plain) == 200 and len(sizes) >= 50
    target = 10 * max(sizes)
    packed = cdc.CompactedBronze(spark, bronze, str(tmp_path / "packed"), target)
    assert sorted(map(str, packed.read().collect())) == plain  # nothing packed yet
    assert packed.compact() == len(sizes)
    assert sorted(map(str, packed.read().collect())) == plain
    files = [f for d, _, names in os.walk(tmp_path / "packed") if "attempt=" in d for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * (1 + sum(sizes) / 2 // (target // 2) + 1)
    assert packed.compact() == 0
    cdc.land_events(make(51), land, files=1)
    cdc.run_bronze(spark, land, bronze, str(tmp_path / "ck"))
    assert packed.read().count() == 204  # what came later is read from bronze
    os.makedirs(tmp_path / "packed" / "attempt=unfinished" / "entity_name=Seller", exist_ok=True)  # a run cut short
    assert packed.read().count() == 204
