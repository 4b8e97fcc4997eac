"""Data-quality checks as DataFrames of findings.

All checks are grouped counts (partial aggregation map-side, so a key that
holds a large share of the rows is combined before the shuffle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


def duplicate_keys(df: DataFrame, keys: list[str], table_name: str) -> DataFrame:
    """Natural keys that occur more than once: (table_name, key_value, n)."""
    kv = F.concat_ws("|", *[F.coalesce(c(k).cast("string"), F.lit("<null>")) for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(c("n") > 1)
        .select(F.lit(table_name).alias("table_name"), kv.alias("key_value"), "n")
    )


def duplicate_keys_all(checks: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [duplicate_keys(df, k, n) for df, k, n in checks])


def current_version_histogram(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """How many keys have 0, 1, 2, ... current versions (exactly one is
    expected; 0 is allowed for deleted keys)."""
    per_key = dim.groupBy(key).agg(
        F.sum(F.when(c("current_flag") == True, 1).otherwise(0)).cast("bigint").alias("current_versions")  # noqa: E712
    )
    return per_key.groupBy("current_versions").agg(F.count(F.lit(1)).alias("n_keys"))


def one_current_violations(dim: DataFrame, key: str = "customer_id", allow_zero: bool = False) -> DataFrame:
    per_key = dim.groupBy(key).agg(
        F.sum(F.when(c("current_flag") == True, 1).otherwise(0)).cast("bigint").alias("current_versions")  # noqa: E712
    )
    bad = c("current_versions") > 1 if allow_zero else c("current_versions") != 1
    return per_key.filter(bad)


def fact_grain(df: DataFrame, order_col: str, item_col: str, source: str) -> DataFrame:
    """Repeated fact grains: (source, order_id, order_item_id, n)."""
    return (
        df.groupBy(order_col, item_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(c("n") > 1)
        .select(
            F.lit(source).alias("source"),
            c(order_col).cast("string").alias("order_id"),
            c(item_col).cast("int").alias("order_item_id"),
            "n",
        )
    )


def rows_without_version(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Fact rows whose order day falls in no version of their customer; the
    as-of views drop them (e.g. orders placed before a customer's first
    version). Anti join on the key with the date range as condition."""
    day = dim_date.select(c("date_sk").alias("_dsk"), c("calendar_date").alias("order_date"))
    f = fact.join(day, c("date_sk") == c("_dsk")).select("order_id", "order_item_id", "customer_id", "order_date")
    v = dim_customer.select(c("customer_id").alias("_cid"), "effective_date", "expiry_date")
    cond = (c("customer_id") == c("_cid")) & c("order_date").between(c("effective_date"), c("expiry_date"))
    return f.join(v, cond, "left_anti")
