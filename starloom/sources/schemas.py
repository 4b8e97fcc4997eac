"""Declared schemas of the raw retail source tables and a typed reader.

Money is ``decimal(18,2)``: a bare DECIMAL means ``decimal(10,0)`` in Spark and
would drop the cents. Order lifecycle columns are timestamps (the model casts
them to dates where it needs a day).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _s(
        ("customer_id", T.StringType()),
        ("customer_unique_id", T.StringType()),
        ("customer_zip_code_prefix", T.IntegerType()),
        ("customer_city", T.StringType()),
        ("customer_state", T.StringType()),
    ),
    "products": _s(
        ("product_id", T.StringType()),
        ("product_category_name", T.StringType()),
        ("product_name_lenght", T.IntegerType()),
        ("product_description_lenght", T.IntegerType()),
        ("product_photos_qty", T.IntegerType()),
        ("product_weight_g", T.IntegerType()),
        ("product_length_cm", T.IntegerType()),
        ("product_height_cm", T.IntegerType()),
        ("product_width_cm", T.IntegerType()),
    ),
    "category_translation": _s(
        ("product_category_name", T.StringType()),
        ("product_category_name_english", T.StringType()),
    ),
    "sellers": _s(
        ("seller_id", T.StringType()),
        ("seller_zip_code_prefix", T.IntegerType()),
        ("seller_city", T.StringType()),
        ("seller_state", T.StringType()),
    ),
    "geolocation": _s(
        ("geolocation_zip_code_prefix", T.StringType()),
        ("geolocation_lat", T.DoubleType()),
        ("geolocation_lng", T.DoubleType()),
        ("geolocation_city", T.StringType()),
        ("geolocation_state", T.StringType()),
    ),
    "payments": _s(
        ("order_id", T.StringType()),
        ("payment_sequential", T.IntegerType()),
        ("payment_type", T.StringType()),
        ("payment_installments", T.IntegerType()),
        ("payment_value", MONEY),
    ),
    "orders": _s(
        ("order_id", T.StringType()),
        ("customer_id", T.StringType()),
        ("order_status", T.StringType()),
        ("order_purchase_timestamp", T.TimestampNTZType()),
        ("order_approved_at", T.TimestampNTZType()),
        ("order_delivered_carrier_date", T.TimestampNTZType()),
        ("order_delivered_customer_date", T.TimestampNTZType()),
        ("order_estimated_delivery_date", T.TimestampNTZType()),
    ),
    "order_items": _s(
        ("order_id", T.StringType()),
        ("order_item_id", T.IntegerType()),
        ("product_id", T.StringType()),
        ("seller_id", T.StringType()),
        ("shipping_limit_date", T.TimestampNTZType()),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
}


def read_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read one raw source table with its declared schema (csv/json/parquet)."""
    reader = spark.read.schema(SOURCE_SCHEMAS[name])
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.options(**options).format(fmt).load(path)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project a DataFrame onto a source schema (names, order, types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_SCHEMAS[name].fields])


RECORD = "_record"
REJECTS = "table_name string, source_file string, record string"


def land_source(spark: SparkSession, name: str, path: str, fmt: str = "csv", **options: str) -> tuple[DataFrame, DataFrame]:
    """Take in one raw source table (csv or json files): (rows, rejects).

    The files are parsed once, with the declared types, and written as they come
    out of it; a record that does not fit (a number that is none, columns too many
    or too few, broken JSON) has its raw text in a column of its own. Both results
    read that copy, so what is a reject does not depend on the columns a query
    reads. Parquet files carry their types and have no rejects."""
    from starloom.functions.storage import materialize

    if fmt == "parquet":
        rows = read_source(spark, name, path)
        return rows, spark.createDataFrame([], REJECTS)
    schema = T.StructType([*SOURCE_SCHEMAS[name].fields, T.StructField(RECORD, T.StringType(), True)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    raw = reader.options(**options).format(fmt).load(path).withColumn("_file", F.col("_metadata.file_name"))
    raw = materialize(raw, f"landed-{name}")
    rejects = raw.filter(F.col(RECORD).isNotNull()).select(F.lit(name).alias("table_name"), F.col("_file").alias("source_file"), F.col(RECORD).alias("record"))
    return raw.filter(F.col(RECORD).isNull()).select(*SOURCE_SCHEMAS[name].fieldNames()), rejects


def land_sources(spark: SparkSession, folder: str, fmt: str = "csv", names: list[str] | None = None, **options: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All source tables from ``folder/<name>``, as ``plans.warehouse.build`` takes
    them, and the rejects of all."""
    landed = {n: land_source(spark, n, f"{folder}/{n}", fmt, **options) for n in (names or SOURCE_SCHEMAS)}
    rejects = [r for _, r in landed.values()]
    return {n: rows for n, (rows, _) in landed.items()}, reduce(DataFrame.unionByName, rejects)


def reject_report(sources: dict[str, DataFrame], rejects: DataFrame) -> DataFrame:
    """(table_name, n_rows, n_rejects) of landed tables."""
    taken = reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(n)) for n, df in sources.items()])
    bad = rejects.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rejects"))
    return taken.join(bad, "table_name", "left").select("table_name", "n_rows", F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"))
