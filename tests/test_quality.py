from starloom.operators import quality


def test_duplicate_keys_and_grain(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "o string, i int")
    got = sorted((r.key_value, r.n) for r in quality.duplicate_keys(df, ["o", "i"], "t").collect())
    assert got == [("<null>|2", 2), ("a|1", 2)]
    g = quality.fact_grain(df, "o", "i", "t").collect()
    assert sorted((r.order_id, r.order_item_id, r.n) for r in g if r.order_id) == [("a", 1, 2)]


def test_current_version_histogram(spark):
    df = spark.createDataFrame(
        [("a", True), ("a", False), ("b", False), ("c", True), ("c", True)], "customer_id string, current_flag boolean"
    )
    got = sorted(tuple(r) for r in quality.current_version_histogram(df).collect())
    assert got == [(0, 1), (1, 1), (2, 1)]
    bad = sorted(r.customer_id for r in quality.one_current_violations(df).collect())
    assert bad == ["b", "c"]
