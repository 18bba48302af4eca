"""Text tables: one text per row under a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textguard.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table to scan, with only the columns in question and a task per core."""
    return spread(table(spark, folder, name).select(*columns))
