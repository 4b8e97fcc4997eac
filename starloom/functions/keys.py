"""Surrogate keys: dense BIGINT numbering in natural-key order, without a
single-partition sort.

``ROW_NUMBER() OVER (ORDER BY key)`` moves every row into one task. Instead:
range-partition on the key, sort inside each partition, tag each row with its
partition id and in-partition position, write that once (so the sampled range
boundaries and positions are fixed), then add the row count of all earlier
partitions. The per-partition count table has one row per partition, a proven
bound, so it is collected, summed up and joined back as a broadcast table (a
hash lookup per row, at every partition count). The result equals
``start - 1 + ROW_NUMBER() OVER (ORDER BY key ASC NULLS FIRST)``.

Retries: a re-run task numbers its partition 0..n-1 again, and only the
committed attempt's output is ever read, so keys stay unique and dense.
With a unique ``order_by`` they are also the same on every rebuild; among
rows with equal keys the order (and so the numbering) is not fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.storage import materialize

_PID, _MID = "_sk_pid", "_sk_mid"


def assign_surrogate_keys(
    df: DataFrame,
    order_by: list[str],
    sk_col: str,
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys: list[Column] = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, f"keys-{sk_col}")
    counts = sorted(ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n"), F.min(_MID).alias("m0")).collect())
    shift, seen = {}, 0
    for pid, n, m0 in counts:  # key = start + rows before this partition + position in it
        shift[pid] = start + seen - m0
        seen += n
    if not shift:
        return ranged.select(F.lit(None).cast("bigint").alias(sk_col), *df.columns)
    offsets = spark.createDataFrame(sorted(shift.items()), f"{_PID} int, _sk_shift long")
    return ranged.join(F.broadcast(offsets), _PID).select(
        (F.col("_sk_shift") + F.col(_MID)).cast("bigint").alias(sk_col), *df.columns
    )


def keep_keys(
    df: DataFrame,
    order_by: list[str],
    sk_col: str,
    previous: DataFrame | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Surrogate keys that stay put across rebuilds.

    Without ``previous``: ``assign_surrogate_keys``. With the previous
    version of the dimension, rows whose natural key (``order_by``) is known
    keep their key (null-safe equi join); only new natural keys are numbered,
    after the largest existing key, in natural-key order."""
    if previous is None:
        return assign_surrogate_keys(df, order_by, sk_col, num_partitions=num_partitions)
    known = previous.select(*[F.col(k).alias(f"_k_{k}") for k in order_by], F.col(sk_col).alias("_k_sk"))
    cond = None
    for k in order_by:
        t = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        cond = t if cond is None else cond & t
    joined = df.join(known, cond, "left")
    old = joined.filter(F.col("_k_sk").isNotNull()).select(F.col("_k_sk").alias(sk_col), *df.columns)
    fresh = joined.filter(F.col("_k_sk").isNull()).select(*df.columns)
    top = previous.agg(F.max(sk_col)).first()[0] or 0
    new = assign_surrogate_keys(fresh, order_by, sk_col, start=int(top) + 1, num_partitions=num_partitions)
    return old.unionByName(new)
