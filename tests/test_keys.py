"""Surrogate keys equal ROW_NUMBER() OVER (ORDER BY key NULLS FIRST)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions.keys import assign_surrogate_keys


def test_dense_keys_in_key_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5003).cast("string").alias("k"), F.col("id").alias("v")
    ).union(spark.createDataFrame([(None, -1)], "k string, v long"))
    got = assign_surrogate_keys(df, ["k"], "sk", num_partitions=5)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())))
    assert sorted((r.sk, r.k) for r in got.collect()) == sorted((r.sk, r.k) for r in want.collect())
    assert got.filter(F.col("k").isNull()).first().sk == 1


def test_start_offset_and_composite_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("a", 1), ("c", None)], "x string, y int")
    got = assign_surrogate_keys(df, ["x", "y"], "sk", start=101)
    assert sorted((r.x, r.y, r.sk) for r in got.collect()) == [
        ("a", 1, 101), ("a", 2, 102), ("b", 2, 103), ("c", None, 104)
    ]


def test_empty_input(spark):
    df = spark.createDataFrame([], "x string")
    assert assign_surrogate_keys(df, ["x"], "sk").count() == 0


def test_many_partitions(spark):
    df = spark.range(0, 300, numPartitions=3).select((F.col("id") * 37 % 300).alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sk", num_partitions=4000)
    assert sorted((r.k, r.sk) for r in got.collect()) == [(i, i + 1) for i in range(300)]
    plan = got._jdf.queryExecution().toString()
    assert "map(" not in plan and "element_at" not in plan  # one path: a join with the offsets


def test_keys_stay_put_across_rebuilds(spark):
    from starloom.operators import dims

    prods = spark.createDataFrame(
        [(f"p{i:02d}", "ECONOMY", 5, 10, 1, 2, 3, 4, 5) for i in range(0, 10, 2)],
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, product_length_cm int, "
        "product_height_cm int, product_width_cm int",
    )
    tr = spark.createDataFrame([("ECONOMY", "economy")], "product_category_name string, "
                                                        "product_category_name_english string")
    v1 = dims.build_dim_product(prods, tr)
    first = {r.product_id: r.product_sk for r in v1.collect()}
    assert first == {"p00": 1, "p02": 2, "p04": 3, "p06": 4, "p08": 5}
    more = prods.unionByName(prods.filter("product_id = 'p02'").withColumn("product_id", F.lit("p03")))
    v2 = dims.build_dim_product(more, tr, previous=v1)
    second = {r.product_id: r.product_sk for r in v2.collect()}
    assert {k: second[k] for k in first} == first     # known keys unchanged
    assert second["p03"] == 6                          # new key after the largest
    # without the previous version the order-based numbering would shift p04..
    assert {r.product_id: r.product_sk for r in dims.build_dim_product(more, tr).collect()}["p04"] == 4
