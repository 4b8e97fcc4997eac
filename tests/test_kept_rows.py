"""Rows that stay are not shuffled when the rows beside them are written anew."""

import pytest
from pyspark.sql import functions as F

from starloom.functions import publish, storage
from test_publish import content, parts, rows


@pytest.mark.parametrize("few", [0, 2, 100])
def test_matching_and_lacking_are_semi_and_anti_joins(spark, monkeypatch, few):
    df = rows(spark, (1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e"), (None, "f"))
    named = storage.write_table(spark.createDataFrame([(1,), (2,), (3,), (9,), (None,)], "k long"), storage.table_path(df, "named"))
    monkeypatch.setattr(storage, "BROADCAST_ROWS", few)  # 2: only the keys that are not named are few
    got = lambda made: sorted(r.v for r in made.collect())
    assert got(storage.matching(df, named, "k")) == ["a", "b", "c", "d"]
    assert got(storage.lacking(df, named, "k")) == ["e", "f"]


def test_a_set_of_nearly_all_keys_shuffles_no_row(spark, monkeypatch, tmp_path):
    wide = storage.write_table(spark.range(1000).selectExpr("id AS k", "repeat('x', 100) AS v"), str(tmp_path / "wide"))
    named = storage.write_table(spark.range(1, 1000).withColumnRenamed("id", "k"), str(tmp_path / "named"))
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 10)
    for how in (storage.matching, storage.lacking):
        made = how(wide, named, "k")
        assert "Exchange hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
        assert made.count() == (999 if how is storage.matching else 1)


def test_kept_rows_are_written_where_they_are_read(spark, tmp_path):
    p = parts(spark, str(tmp_path / "t"))
    p.stage("a", rows(spark, *[(k, "old") for k in range(8)]))
    p.publish()
    kept = p.read("a", [1, 2]).filter("k != 1")
    assert p.stage("a", rows(spark, (1, "new"), (10, "more")), [1, 2], kept) == {"rows": 5, "in_another_part": 0, "repeated_key": 0, "k": 10}
    p.publish()
    want = {0: "old", 1: "new", 2: "old", 3: "old", 4: "old", 5: "old", 6: "old", 7: "old", 10: "more"}
    assert content(p, "a") == sorted(want.items())
    with pytest.raises(publish.AuditError) as e:  # one among the kept rows, and one that is kept and new
        p.stage("a", rows(spark, (2, "again"), (6, "again")), [2], p.read("a", [2]))
    assert e.value.counts == {"rows": 5, "repeated_key": 2}
    with pytest.raises(publish.AuditError) as e:
        p.stage("a", rows(spark), [2], p.read("a", [3]))
    assert e.value.counts["in_another_part"] == 2
    p.discard()
    assert content(p, "a") == sorted(want.items())


def test_kept_rows_do_not_scatter(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(publish, "MOST_FILES", 2)
    p = parts(spark, str(tmp_path / "t"))
    p.stage("a", rows(spark, *[(4 * k, "old") for k in range(10)]))
    p.publish()
    most = 0
    for n in range(12):
        kept = p.read("a", [0]).filter(F.col("k") != 4 * (n % 10))
        p.stage("a", rows(spark, (4 * (n % 10), f"new {n}")), [0], kept.repartition(3))
        p.publish()
        most = max(most, len(p.read("a", [0]).inputFiles()))
    assert most <= 2 * 2 + 4
    assert content(p, "a") == [(4 * k, f"new {k if k > 1 else 10 + k}") for k in range(10)]
