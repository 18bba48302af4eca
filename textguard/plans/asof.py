"""As-of joins: for each row the latest of another table's rows up to its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def _span(at: Column, span: int) -> Column:
    return F.floor(F.unix_micros(at.cast("timestamp")) / span)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_at: str,
    right_at: str,
    values: Sequence[str],
    span: int = DAY,
) -> DataFrame:
    """The left rows with ``values`` of the right row of the same key that is latest at their time.

    A right row of the very same time counts; of several at one time the greatest values do. Both
    sides are united and sorted by time within a key and a span of so many microseconds, so a
    key with most of the rows is sorted in many tasks. What a span carries into the next is
    its last right row, one row per key and span. Rows without a match, or without a key or
    a time, come back with NULL values.
    """
    found = F.struct(*[F.col(name) for name in values])
    rows = left.select(
        F.col(key).alias("__key"), F.col(left_at).alias("__at"), F.struct("*").alias("__row")
    )
    known = right.filter(F.col(key).isNotNull() & F.col(right_at).isNotNull()).select(
        F.col(key).alias("__key"), F.col(right_at).alias("__at"), found.alias("__value")
    )
    both = rows.unionByName(known, allowMissingColumns=True).withColumn("__span", _span(F.col("__at"), span))
    order = ["__at", F.col("__row").isNotNull(), "__value"]
    before = Window.partitionBy("__key", "__span").orderBy(*order)
    before = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.withColumn("__inside", F.last("__value", ignorenulls=True).over(before))
    inside = inside.filter(F.col("__row").isNotNull()).select("__key", "__span", "__row", "__inside")
    ends = known.groupBy("__key", _span(F.col("__at"), span).alias("__span")).agg(
        F.max(F.struct("__at", "__value"))["__value"].alias("__end")
    )
    wanted = rows.filter(F.col("__key").isNotNull() & F.col("__at").isNotNull())
    wanted = wanted.select("__key", _span(F.col("__at"), span).alias("__span")).distinct()
    spans = wanted.unionByName(ends, allowMissingColumns=True).groupBy("__key", "__span").agg(
        F.first("__end", ignorenulls=True).alias("__end")
    )
    earlier = Window.partitionBy("__key").orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("__key", "__span", F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
    value = F.coalesce("__inside", "__carried")
    joined = inside.join(carried, ["__key", "__span"], "left").select("__row", value.alias("__value"))
    return joined.select("__row.*", *[F.col("__value")[name].alias(name) for name in values])
