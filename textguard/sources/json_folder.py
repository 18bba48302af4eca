"""JSON documents from folders and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_documents(rows: DataFrame, path: Column, json: Column, *keep: Column) -> DataFrame:
    """(file_path, data VARIANT); data is NULL where the text is no JSON.

    Of equal names in one object the last one counts.
    """
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return rows.select(path.alias("file_path"), F.try_parse_json(json).alias("data"), *keep)


def json_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """(file_path, data, value): all files of one folder level, each one document, with its text.

    One pass for what asks for good and bad files together.
    """
    files = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", False)
        .text(folder)
    )
    return parse_documents(files, F.col("_metadata.file_path"), F.col("value"), F.col("value"))


def read_json_folder(
    spark: SparkSession, folder: str, pattern: str = "*.json"
) -> tuple[DataFrame, DataFrame]:
    """All files of one folder level, each one document, and the bad files among
    them, which have no data.

    No matching file is no error: both tables are then empty.
    """
    parsed = json_files(spark, folder, pattern).drop("value")
    return parsed, parsed.filter(F.col("data").isNull()).select("file_path")


def load_json_folder(
    spark: SparkSession, folder: str, pattern: str = "*.json"
) -> tuple[DataFrame, DataFrame]:
    """Good documents and bad files."""
    parsed, bad = read_json_folder(spark, folder, pattern)
    return parsed.filter(F.col("data").isNotNull()), bad
