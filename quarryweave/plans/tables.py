"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder, read with its own schema."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
