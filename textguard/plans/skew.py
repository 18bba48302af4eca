"""Joins and numberings that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textguard.session import is_small, stage

HOT_SHARE = 1000
SALTS = 64


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Keys with over 1/1000 of all rows: there can be no more than 1000 of them,
    so this table may always be broadcast."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) * HOT_SHARE > total).select(key)


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    counts: Callable[[], tuple[DataFrame, str]],
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join many rows with a staged lookup that is unique per key.

    A lookup that is counted and found short is broadcast. Beyond that the rows of
    a hot key are dealt out over several partitions by a hash of ``spread_by``, and
    the lookup row of that key is copied to each of them; ``counts`` gives a table
    of rows per key and the name of its count.
    """
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), key, how)
    numbers, n = counts()
    hot = hot_keys(numbers, key, n)
    marked = F.broadcast(hot.select(key, F.lit(True).alias("__hot")))
    dealt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    salted_rows = rows.join(marked, key, "left").withColumn(
        "__salt", F.when(F.col("__hot"), dealt).otherwise(F.lit(0))
    )
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_lookup = (
        lookup.join(marked, key, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    )
    return salted_rows.join(salted_lookup, [key, "__salt"], how).drop("__hot", "__salt")


def number_rows(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add 0, 1, 2, ... in the order of a unique column, without one global sort task.

    The rows are range partitioned and staged with their partition number; the
    offset of each partition is the number of rows in the partitions before it.
    """
    part = "__part"
    ranged = stage(
        df.repartitionByRange(order).withColumn(part, F.spark_partition_id()), "numbered"
    )
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy(part).orderBy(order))
    return (
        ranged.withColumn("__row", within)
        .join(F.broadcast(offsets), part)
        .withColumn(out, F.col("__offset") + F.col("__row") - 1)
        .drop(part, "__row", "__offset")
    )


def next_in_group(
    df: DataFrame, group: str, order: str, values: Sequence[str], span: int = 100_000
) -> DataFrame:
    """Add ``next``, the values of the following row of the group, by order.

    A group is cut into spans of the order column, a number, so that the rows of
    one long group are sorted in many tasks. Only the last row of a span looks
    across, at the first row of the next span that has any.
    """
    row = F.struct(F.col(order), *[F.col(name) for name in values])
    within = Window.partitionBy(group, "__span").orderBy(order)
    spans = (
        df.withColumn("__span", F.floor(F.col(order) / span))
        .withColumn("__inside", F.lead(row).over(within))
        .withColumn("__at", F.row_number().over(within))
    )
    heads = spans.filter(F.col("__at") == 1).select(group, "__span", row.alias("__head"))
    following = heads.select(
        F.col(group).alias("__group"),
        F.col("__span").alias("__of"),
        F.lead("__head").over(Window.partitionBy(group).orderBy("__span")).alias("__next_head"),
    )
    # NULL is a group like any other.
    same = spans[group].eqNullSafe(F.col("__group")) & spans["__span"].eqNullSafe(F.col("__of"))
    return (
        spans.join(following, same)
        .withColumn("next", F.coalesce("__inside", "__next_head"))
        .drop("__span", "__inside", "__at", "__next_head", "__group", "__of")
    )
