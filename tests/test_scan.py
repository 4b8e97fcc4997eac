"""Segmented scans equal windows per key, and spread a hot key over tasks."""

import datetime as dt
import random

import pytest
from helpers import D
from pyspark.sql import Window
from pyspark.sql import functions as F
from starloom.functions import scan
from starloom.operators import cdc_apply, scd2


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    keys = ["hot"] * 400 + ["a", "b", None, "z", "i"] * 12
    seen = {(k, rng.randint(0, 3000)) for k in keys}
    return spark.createDataFrame([(k, d, rng.choice([None, d * 7 % 11])) for k, d in sorted(seen, key=str)], "k string, d int, v int")


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_equals_window(spark, rows, inclusive, following):
    by = F.col("d").desc() if following else F.col("d").asc()
    w = Window.partitionBy("k").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    pick = F.min if following else F.max
    want = rows.select("k", "d", pick("v").over(w).alias("m"), pick(F.struct("d", "v")).over(w).alias("s"))
    seg = scan.segmented(rows, ["k"], "d", ranges=12)
    hot = seg.filter("k = 'hot'").select(scan.RANGE).distinct().count()
    assert hot > 4  # the hot key is in several ranges
    got = scan.running(seg, [scan.RANGE, "k"], "d", {"m": "v", "s": F.struct("d", "v")}, inclusive, following)
    assert sorted(map(str, got.select("k", "d", "m", "s").collect())) == sorted(map(str, want.collect()))
    plain = scan.running(rows, ["k"], "d", {"m": "v", "s": F.struct("d", "v")}, inclusive, following)
    assert sorted(map(str, plain.select("k", "d", "m", "s").collect())) == sorted(map(str, want.collect()))


def observations(spark, hot):
    rng = random.Random(hot)
    day = lambda: D(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 4000))
    make = lambda k: (k, "u", rng.choice([1, 1, 2, None]), rng.choice(["c", "c", "d", None]), "S", day(), rng.randint(0, 3))
    data = [make("hot") for _ in range(hot)] + [make(f"k{i % 40}") for i in range(hot)] + [make(None) for _ in range(20)]
    return spark.createDataFrame(data, "customer_id string, customer_unique_id string, geography_sk long, customer_city string, customer_state string, obs_date date, obs_rank long").dropDuplicates(["customer_id", "obs_date", "obs_rank"])


def test_timeline_of_a_hot_key(spark):
    """Half of all days belong to one customer."""
    obs = observations(spark, 600)
    want = sorted(map(str, scd2.timeline(obs).collect()))
    assert want == sorted(map(str, scd2.timeline(obs, hot_days=10).collect())) and len(want) > 200


def test_event_days_of_a_hot_key(spark):
    obs = observations(spark, 400)
    fold = cdc_apply.fold_customer_days(cdc_apply.observation_rows(obs))
    # some of the days are changes of one attribute, some are deletes
    ev = obs.select(F.col("customer_id"), F.date_add("obs_date", 1).alias("day"), cdc_apply._ord(F.col("obs_date"), F.col("obs_rank"), 1).alias("ord"),
                    F.when(F.col("obs_rank") == 3, "delete").otherwise("update").alias("op"), F.lit(False).alias("has_uid"), F.lit(None).cast("string").alias("customer_unique_id"),
                    (F.col("obs_rank") % 2 == 0).alias("has_geo"), "geography_sk", (F.col("obs_rank") % 2 == 1).alias("has_customer_city"), "customer_city",
                    F.lit(False).alias("has_customer_state"), "customer_state")
    days = cdc_apply.merge_customer_days(fold, cdc_apply.fold_customer_days(ev))
    want = sorted(map(str, cdc_apply.versions_from_days(days).collect()))
    assert want == sorted(map(str, cdc_apply.versions_from_days(days, hot_days=5).collect())) and len(want) > 100
