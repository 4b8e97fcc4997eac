import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

D = dt.date

DIM_SCHEMA = T.StructType([
    T.StructField("customer_sk", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_unique_id", T.StringType()),
    T.StructField("geography_sk", T.LongType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
    T.StructField("effective_date", T.DateType()),
    T.StructField("expiry_date", T.DateType()),
    T.StructField("current_flag", T.BooleanType()),
])

SNAP_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_unique_id", T.StringType()),
    T.StructField("geography_sk", T.LongType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
    T.StructField("snapshot_date", T.DateType()),
])

OPEN = D(1900, 1, 1)
END = D(9999, 12, 31)


def dim(spark, rows):
    return spark.createDataFrame(rows, DIM_SCHEMA)


def snap(spark, rows):
    return spark.createDataFrame(rows, SNAP_SCHEMA)


def versions(df, key="customer_id"):
    """Sorted (id, city, state, geo, eff, exp, current) tuples."""
    cols = [key, "customer_city", "customer_state", "geography_sk", "effective_date", "expiry_date", "current_flag"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=nulls_first)


def nulls_first(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
