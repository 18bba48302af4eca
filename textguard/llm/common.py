"""What several operators of this package share: words, row keys, word hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textguard.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROW_ID, ROW_TEXT = "__row_id", "__row_text"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when a write ends: every step here ends in a written table, so
    nothing reads them again, and the next step has the disk to itself."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of one byte per character take the
    built-in, which for them does the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text: Column, between: str = BLANKS) -> Column:
    """The parts of a text between matches of a pattern; splitting takes a fraction of
    the time of extracting matches, which copies the text for each of them."""
    return F.filter(F.split(text, between, -1), lambda part: part != "")


def count_words(text: Column, between: str = BLANKS) -> Column:
    return F.coalesce(F.size(words(text, between)), F.lit(0)).cast("long")


def count_chars(text: Column, others: str) -> Column:
    """Characters that remain when runs of the others are removed."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def indexes(first: int, last: Column) -> Column:
    """first, first + 1, ..., last; empty if last is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(
        F.array().cast("array<int>")
    )


def grams(hashes: Column, size: int) -> Column:
    """The hash of each run of so many array elements."""
    return F.transform(
        indexes(0, F.size(hashes) - size),
        lambda i: F.xxhash64(*[F.get(hashes, i + step) for step in range(size)]),
    )


def with_row_key(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Columns that tell rows apart even where ids repeat: rows that agree in id
    and text also agree in all that is computed from them."""
    return df.withColumns({ROW_ID: F.col(id_column), ROW_TEXT: F.xxhash64(F.col(text))})


def same_row(left: DataFrame, right: DataFrame, keys: Sequence[str] = (ROW_ID, ROW_TEXT)) -> Column:
    """Equal keys, where NULL equals NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def number_hash(*parts: Column, digits: int = 12) -> Column:
    """A number of 4 * digits bits from the MD5 of the parts, so that SQL engines agree."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, digits), 16, 10).cast("long")


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Add 0, 1, 2, ... by the order: rows are range partitioned, staged with their place
    within the partition, and moved on by the sizes of the partitions before."""
    key = F.struct(*[column.alias(f"k{at}") for at, column in enumerate(order)])
    ranged = df.withColumn("__order", key).repartitionByRange("__order").sortWithinPartitions("__order")
    placed = stage(ranged.drop("__order").withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__offset") + F.col("__at").bitwiseAND((1 << 33) - 1))
        .drop("__part", "__offset", "__at")
    )
