"""Lineage cuts as written parquet tables in the shared checkpoint folder.

A written table survives executor loss (it lives in shared storage, not in
executor memory/disk) and fixes every non-deterministic choice made while
computing it (range boundaries, partition ids), so later reads agree.
"""

from __future__ import annotations

import os
import sys
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import checkpoint_root


#: About a third smaller than the default.
CODEC = "zstd"


def table_path(df: DataFrame, name: str) -> str:
    root = checkpoint_root(df.sparkSession)
    return f"{root}/starloom-tables/{uuid.uuid4().hex}/{name}"


def layout(df: DataFrame, partition_by: list[str], spread: list[str] | None = None) -> DataFrame:
    """Shuffle rows so a partitioned write makes few files.

    Without ``spread``: one task per partition value (for partitions of
    bounded size, e.g. key buckets). With ``spread``: range partitioning on
    (partition columns, spread columns), so a large partition value is split
    over several tasks and each task writes to one or two partition folders
    instead of every task writing a small file into every folder."""
    if spread:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartitionByRange(n, *partition_by, *spread)
    return df.repartition(*partition_by)


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, spread: list[str] | None = None
) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written copy, which
    goes with the ``temporary`` block it is made in, if there is one."""
    path = table_path(df, name)
    if _MADE:
        _MADE[-1].append(path)
    return write_table(df, path, partition_by, spread)


_MADE: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is materialized in the block, also by its threads, is deleted at its end:
    the tables that a plan needs until its result has been written."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            remove(spark, path)


#: Spark's own switch: the shuffle files of a query go when the query has ended, not
#: when the driver's memory happens to be collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TIDY_LOCK = threading.Lock()
_TIDY: dict[int, list] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in the block leave no shuffle files; afterwards the session's setting
    is what it was. Writes may run side by side."""
    key = spark._jsparkSession.hashCode()  # one JVM session may have several Python objects
    with _TIDY_LOCK:
        if key not in _TIDY:
            _TIDY[key] = [0, spark.conf.get(TIDY, None)]
            spark.conf.set(TIDY, "true")
        _TIDY[key][0] += 1
    try:
        yield
    finally:
        with _TIDY_LOCK:
            _TIDY[key][0] -= 1
            if not _TIDY[key][0]:
                was = _TIDY.pop(key)[1]
                spark.conf.unset(TIDY) if was is None else spark.conf.set(TIDY, was)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, spread: list[str] | None = None
) -> DataFrame:
    """Write ``df`` to ``path`` (replacing what is there) and return a
    DataFrame that reads it."""
    t0 = time.time()
    if partition_by:
        df = layout(df, partition_by, spread)
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    if os.environ.get("STARLOOM_TRACE"):
        print(f"[starloom] wrote {path.rsplit('/', 1)[-1]} in {time.time() - t0:.2f}s", file=sys.stderr)
    # with the schema given, also a write without any row can be read back
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 500_000


def if_small(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of keys with a broadcast hint if it has at most ``rows`` rows
    (counted from the files' footers); a larger one is joined as Spark sees fit."""
    return F.broadcast(written) if written.count() <= rows else written


def _others(df: DataFrame, named: DataFrame, key: str) -> DataFrame | None:
    """The keys of ``df`` that are not ``named``, if they are few; null is one of them."""
    others = materialize(df.select(key).distinct().join(named, key, "left_anti"), "other-keys")
    return F.broadcast(others) if others.count() <= BROADCAST_ROWS else None


def matching(df: DataFrame, named: DataFrame, key: str, of: int | None = None) -> DataFrame:
    """``df`` LEFT SEMI ``named`` (a written table of keys). If the keys are few, or
    those of ``df`` that are not among them, the few are broadcast and the rows of
    ``df`` are not shuffled: a set that holds nearly all keys costs as little as one
    that holds hardly any. ``of``: about how many keys ``df`` has, if that is known;
    those that are not named are then looked for only if they can be few."""
    named = named.select(key)
    n = named.count()
    if n <= BROADCAST_ROWS:
        return df.join(F.broadcast(named), key, "left_semi")
    others = _others(df, named, key) if of is None or of - n <= BROADCAST_ROWS else None
    return df.join(named, key, "left_semi") if others is None else df.filter(F.col(key).isNotNull()).join(others, key, "left_anti")


def lacking(df: DataFrame, named: DataFrame, key: str, of: int | None = None) -> DataFrame:
    """``df`` LEFT ANTI ``named``: the rows that ``matching`` leaves out."""
    named = named.select(key)
    n = named.count()
    if n <= BROADCAST_ROWS:
        return df.join(F.broadcast(named), key, "left_anti")
    others = _others(df, named, key) if of is None or of - n <= BROADCAST_ROWS else None
    if others is None:
        return df.join(named, key, "left_anti")
    return df.join(others.withColumnRenamed(key, "_other"), F.col(key).eqNullSafe(F.col("_other")), "left_semi")


def append(df: DataFrame, path: str) -> DataFrame:
    """Append rows to a stored table by column names and read it back. The rows
    may have columns that the table lacks (its older rows read NULL) and lack
    some that it has (they read NULL)."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", "true").parquet(path)


def remove(spark, path: str) -> None:
    """Delete a staging table of this library (a folder below the checkpoint
    folder) once nothing reads it any more."""
    root = checkpoint_root(spark)
    if not path.startswith(f"{root}/starloom-tables/"):
        raise ValueError(f"{path} is not a staging table below {root}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
