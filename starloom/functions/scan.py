"""Running values along the rows of a key, also of a key that holds most rows.

A window per key puts a key's rows into one task. ``segmented`` instead deals rows
out by range of (key, order), so a long key spans several ranges, and fixes the
ranges by writing them once. ``running`` then works in two levels: a window inside
each (range, key), and what came before it, carried over the borders. Only the last
key of a range can go on in the next one and only the first key of a range can have
begun earlier, so the carried table has at most two rows a range: a proven bound,
therefore it is broadcast.

Everything is a running maximum (or minimum) of one column, which may be a struct:
a forward fill is the maximum of (ordering, value), the previous row is the maximum
of (order, values) over the rows before, the next one the minimum over those after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.storage import materialize

RANGE = "_range"
c = F.col


def segmented(df: DataFrame, keys: list[str], order: str, name: str = "segments", ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of (keys, order), with the range's number."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [c(x).asc_nulls_first() for x in [*keys, order]]
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return materialize(ranged.withColumn(RANGE, F.spark_partition_id()), name)


def running(df: DataFrame, keys: list[str], order: str, values: dict[str, str | Column], inclusive: bool = True, following: bool = False) -> DataFrame:
    """``df`` with, for each ``name: value``, the greatest value of the key's rows up
    to this one (``inclusive``) or before it; ``following``: the least one from this
    row on, or after it. ``keys`` that begin with ``RANGE``: rows of ``segmented``."""
    pick = F.min if following else F.max
    by = c(order).desc() if following else c(order).asc()
    near = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    cols = {f"_v_{n}": (c(v) if isinstance(v, str) else v) for n, v in values.items()}
    df = df.withColumns(cols)
    local = df.withColumns({n: pick(f"_v_{n}").over(near) for n in values})
    if keys[0] != RANGE:
        return local.drop(*cols)
    own = keys[1:]
    edge = F.struct(*[c(x) for x in own])
    # in the direction of the scan: the key a range goes on with, and the one it begins with
    out_of, into = (F.min, F.max) if following else (F.max, F.min)
    ends = df.groupBy(RANGE).agg(out_of(edge).alias("_out"), into(edge).alias("_in"))
    last = df.join(F.broadcast(ends.select(RANGE, "_out")), RANGE).filter(edge.eqNullSafe(c("_out")))
    gives = last.groupBy(RANGE, "_out").agg(*[pick(x).alias(x) for x in cols]).withColumnRenamed("_out", "_key").withColumn("_gives", F.lit(1))
    takes = ends.select(RANGE, c("_in").alias("_key"), F.lit(0).alias("_gives"))
    marks = gives.unionByName(takes, allowMissingColumns=True)
    step = c(RANGE).desc() if following else c(RANGE).asc()
    before = Window.partitionBy("_key").orderBy(step, "_gives").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumns({f"_c_{n}": pick(f"_v_{n}").over(before) for n in values}).filter("_gives = 0")
    carried = carried.select(c(RANGE).alias("_cr"), c("_key").alias("_ck"), *[f"_c_{n}" for n in values])
    joined = local.join(F.broadcast(carried), (c(RANGE) == c("_cr")) & edge.eqNullSafe(c("_ck")), "left")
    both = {n: _pair(following, c(n), c(f"_c_{n}")) for n in values}
    return joined.withColumns(both).drop(*cols, "_cr", "_ck", *[f"_c_{n}" for n in values])


def _pair(following: bool, a: Column, b: Column) -> Column:
    return (F.least if following else F.greatest)(a, b)  # both skip nulls
