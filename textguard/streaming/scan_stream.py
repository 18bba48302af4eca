"""Row-local rules over a stream, with windowed violation counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.operators.rule import Rule, scan


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def violation_counts(
    stream: DataFrame,
    time: str,
    text: str,
    rule: Rule,
    by: Sequence[str] = (),
    window: str = "1 hour",
    delay: str = "10 minutes",
) -> DataFrame:
    """Rows and violations per tumbling window; rows later than ``delay`` are dropped."""
    timed = scan(
        stream.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", delay),
        text,
        rule,
        out=["scan"],
    )
    return (
        timed.groupBy(F.window("__time", window), *by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~F.col("scan.is_valid")).alias("n_violations"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            *by,
            "n_rows",
            "n_violations",
        )
    )


def run_to_files(counts: DataFrame, output: str, checkpoint: str) -> DataFrame:
    """Process what is there, appending closed windows to parquet files."""
    query = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return counts.sparkSession.read.schema(counts.schema).parquet(output)
