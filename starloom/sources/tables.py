"""Loading the driver's parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class TableSet(dict):
    """Lazily loaded ``name -> DataFrame`` registry over one folder."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark = spark
        self.root = root.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        self[name] = df
        return df


def load_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)
