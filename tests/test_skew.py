"""A customer holding a third of all order items: the as-of join is split by
AQE's skew handling (checked in the final adaptive plan) and the results are
the same as without it."""

import contextlib
import io
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.plans import views
from starloom.plans.warehouse import warehouse

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_hot_customer_is_split_and_results_hold(spark):
    w = warehouse(spark, SF_SMALL)
    hot = w.dim_customer.filter("current_flag").orderBy("customer_id").first().customer_id
    # a third of the items move to one customer (derived from the real fact);
    # AQE splits a skewed partition by groups of map outputs, so the small
    # test fact is spread over several map tasks as a big one would be
    fact = w.fact_order_item.repartition(8).withColumn(
        "customer_id", F.when(F.xxhash64("order_id") % 3 == 0, F.lit(hot)).otherwise(F.col("customer_id"))
    )
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        df = views.as_of(views._base(fact, w.dim_date), views.customer_versions(w.dim_customer), "order_date")
        agg = df.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n"), F.sum("item_total").alias("s"))
        got = sorted(agg.collect())
        plan = final_plan(agg)
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan.replace(" ", "").lower() or "isskewjoin" in plan.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    df2 = views.as_of(views._base(fact, w.dim_date), views.customer_versions(w.dim_customer), "order_date")
    want = sorted(df2.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n"),
                                                        F.sum("item_total").alias("s")).collect())
    assert got == want
    top = max(got, key=lambda r: r.n)
    assert top.n * 4 > sum(r.n for r in got)  # the hot person really holds a large share


def test_hot_order_is_split(spark):
    """Half of all items belong to one order: the items' only join on the order
    is split, and the fact stays the same."""
    from starloom.operators.fact import build_fact_order_item

    w = warehouse(spark, SF_SMALL)
    src = w.sources
    hot = src["order_items"].select("order_id").orderBy("order_id").first().order_id
    items = src["order_items"].repartition(8).withColumn(
        "order_id", F.when(F.xxhash64("product_id", "order_item_id", "price") % 2 == 0, F.lit(hot)).otherwise(F.col("order_id")))

    def build():
        return build_fact_order_item(items, src["orders"], src["payments"], w.dim_customer, w.dim_product, w.dim_seller,
                                     w.dim_geography, w.dim_date, w.dim_payment)

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        df = build()
        got = sorted(map(str, df.collect()))
        lines = [x for x in final_plan(df).split("Initial Plan")[0].splitlines() if "SortMergeJoin" in x]
        assert any("skew=true" in x.replace(" ", "") for x in lines), lines
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == sorted(map(str, build().collect()))


def test_as_of_customer_with_many_versions(spark):
    """1,000 versions of one customer who has half of the items: spans of days are a
    second join key, and the result is that of the plain join."""
    import datetime as dt

    first = dt.date(2015, 1, 1)
    day = lambda n: first + dt.timedelta(days=n)
    rows, begin = [], [0, *sorted(random.Random(1).sample(range(3, 4000), 999))]
    for i, b in enumerate(begin):
        start = dt.date(1900, 1, 1) if i == 0 else day(b)
        end = day(begin[i + 1] - 1) if i < 999 else dt.date(9999, 12, 31)
        rows.append(("hot", f"c{i}", start, end))
    rows += [(f"k{i}", "c", dt.date(1900, 1, 1), dt.date(9999, 12, 31)) for i in range(300)] + [(None, "n", first, day(9)), ("hot", "empty", day(50), day(49))]
    dim = spark.createDataFrame(rows, "customer_id string, customer_city string, effective_date date, expiry_date date").selectExpr(
        "*", "customer_id as customer_unique_id", "cast(1 as long) as geography_sk", "'S' as customer_state", "expiry_date >= '9999-01-01' as current_flag")
    rng = random.Random(2)
    items = spark.createDataFrame([(n, "hot" if n % 2 else rng.choice([f"k{n % 400}", None]), day(rng.randint(-500, 5000))) for n in range(6000)], "n int, customer_id string, order_date date")
    many = views.many_versions(dim)
    assert [r._hid for r in many.collect()] == ["hot"] and views.many_versions(dim, 2000) is None
    spread = items.join(many, items.customer_id == many._hid).select(views._span("order_date").alias("s")).groupBy("s").count().collect()
    assert len(spread) > 500  # one customer's items are in many groups
    versions = views.customer_versions(dim)
    plain = views.as_of(items, versions, "order_date")
    cut = views.as_of(items, versions, "order_date", many)
    assert sorted(map(str, cut.select(*plain.columns).collect())) == sorted(map(str, plain.collect())) and plain.count() > 4000
