"""Parquet table loading."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder that holds ``<name>.parquet`` files or directories."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
