"""Mixing sources to target weights with nested hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textguard.llm.common import count_words, number_hash
from textguard.plans.skew import spread_join
from textguard.session import broadcast_if_small, scratch, stage

HASH_BITS = 48
STEP_BITS = 12
NO_BLANK = r"[^\x20\x09-\x0D]"
SOURCE, SIZE, HASH = "__source", "__size", "__hash"


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Add ``target`` to a table of one row per source.

    Sources by code point, NULL last, take the weights in turn. ``share`` times the
    whole size is dealt out by weight; no source gets over ``most`` times its size,
    and what is above goes to the others by weight. The level that settles this
    is found without rounds: sources fill up in the order of size by weight, so the
    level is what remains after the first few have been filled, by the weight of the
    rest, for the first such split that agrees with itself. The windows run over one
    row per source and not over documents.
    """
    order = Window.orderBy(F.col(source).isNull(), F.col(source))
    place = F.row_number().over(order) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    filling = Window.orderBy(F.col("__top") / F.col("__weight"), F.col("__place"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(0))
    levels = (
        sizes.withColumns({"__place": place, "__weight": weight, "__top": most * F.col(size)})
        .withColumn("__budget", share * F.sum(size).over(everywhere))
        .withColumn(
            "__level",
            (F.col("__budget") - F.coalesce(F.sum("__top").over(before), F.lit(0.0)))
            / F.sum("__weight").over(onward),
        )
        .withColumn("__open", F.col("__top") > F.col("__level") * F.col("__weight"))
        .withColumn("__at", F.struct(F.col("__top") / F.col("__weight"), "__place", "__level"))
        .withColumn("__first", F.min(F.when(F.col("__open"), F.col("__at"))).over(everywhere))
        .withColumn("__level", F.col("__first")["__level"])
    )
    target = F.least("__top", F.coalesce(F.col("__level") * F.col("__weight"), F.col("__top")))
    return levels.select(source, size, target.cast("double").alias("target"))


def _refine(rows: DataFrame, found: DataFrame, shift: int) -> DataFrame:
    """One histogram step: split the boundary bucket of each source and move on.

    ``found`` has per source the words still ``left`` for the boundary bucket and the
    bucket's first hash, ``floor``, and width. Only rows of that bucket are counted.
    """
    inside = rows.join(broadcast_if_small(found), rows[SOURCE].eqNullSafe(found["__key"])).filter(
        (F.col(HASH) >= F.col("floor")) & (F.col(HASH) - F.col("floor") < F.col("width"))
    )
    bucket = F.shiftright(F.col(HASH) - F.col("floor"), shift)
    filled = inside.groupBy("__key", "floor", "left", bucket.alias("bucket")).agg(
        F.sum(SIZE).alias("words")
    )
    upto = Window.partitionBy("__key").orderBy("bucket")
    crossing = (
        filled.withColumn("upto", F.sum("words").over(upto))
        .filter(F.col("upto") >= F.col("left"))
        .groupBy("__key")
        .agg(F.min(F.struct("bucket", "floor", "left", "upto", "words")).alias("b"))
    )
    return crossing.select(
        "__key",
        (F.col("b.floor") + F.shiftleft(F.col("b.bucket"), shift)).alias("floor"),
        F.lit(1 << shift).cast("long").alias("width"),
        (F.col("b.left") - (F.col("b.upto") - F.col("b.words"))).alias("left"),
        F.col("b.words").alias("words"),
    )


def _hashed(id_column: str, text: str) -> Column:
    return number_hash(
        F.lit("mix:"),
        F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
        F.lit(":"),
        F.md5(F.coalesce(F.col(text), F.lit(""))),
    )


def _of(source: str) -> Column:
    """The source as a key of a join, in which NULL is a value of its own."""
    name = F.coalesce(F.col(source), F.lit(""))
    return F.struct(F.col(source).isNull().alias("__none"), name.alias("__name"))


def _limits(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source ``source_size``, ``target``, how many ``whole`` times it is taken, and the hash
    ``limit`` below which a document is taken once more; a kept table."""
    with scratch(rows.sparkSession):
        sizes = rows.groupBy(SOURCE).agg(F.sum(SIZE).alias("source_size"))
        targets = stage(
            source_targets(sizes, SOURCE, "source_size", weights, share, most), "mix-targets"
        )
        whole = F.when(
            F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
        ).otherwise(F.lit(0))
        targets = targets.withColumn("whole", whole.cast("long"))
        found = targets.select(
            F.col(SOURCE).alias("__key"),
            F.lit(0).cast("long").alias("floor"),
            F.lit(1 << HASH_BITS).cast("long").alias("width"),
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"),
            F.lit(0).cast("long").alias("words"),
        ).filter("left > 0")
        for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
            found = stage(_refine(rows, found, shift), "mix-boundary")
        nearer = (F.col("words") - F.col("left")) <= F.col("left")
        limits = targets.join(found, targets[SOURCE].eqNullSafe(found["__key"]), "left").select(
            _of(SOURCE).alias("__of"),
            "source_size",
            "target",
            "whole",
            F.when(nearer, F.col("floor") + 1).otherwise(F.col("floor")).alias("limit"),
        )
        return stage(limits, "mix-limits", keep=True)


def _with_copies(rows: DataFrame, limits: DataFrame, some: Column) -> DataFrame:
    """Add ``copies`` to rows that have a source, a hash and, where ``some``, any words."""

    def counts() -> tuple[DataFrame, str]:
        return rows.groupBy(_of(SOURCE).alias("__of")).agg(F.count(F.lit(1)).alias("n")), "n"

    joined = spread_join(rows.withColumn("__of", _of(SOURCE)), limits, "__of", counts, [HASH])
    extra: Column = F.when(F.col(HASH) < F.col("limit"), 1).otherwise(0)
    copies = F.when(some, F.col("whole") + extra).otherwise(F.lit(0))
    return joined.withColumn("copies", copies.cast("long"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Decide how often each document is taken: ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Each source takes all its documents as many whole times as its target allows,
    and once more those whose hash is below the source's threshold. Thresholds come
    from histograms: words per source and bucket of the hash, then finer buckets
    within the boundary bucket alone, until a bucket is one hash value; nothing is
    sorted by document. A larger budget gives a higher threshold, so mixtures are
    nested. Sizes and hashes are written once and the texts read once.

    Defined cases: NULL and empty texts have size 0 and are never taken. NULL
    sources form one source, the last. NULL ids are hashed as one value. Repeated rows with one id and
    text share a hash and go together, as do all at the threshold: the boundary value
    is taken if that lies nearer to the target than leaving it. An empty table gives
    an empty table. Other columns come back only if named in ``carry``.
    """
    plain = docs.select(
        F.col(id_column),
        *carry,
        F.col(source).alias(SOURCE),
        count_words(F.col(text)).alias(SIZE),
        _hashed(id_column, text).alias(HASH),
    )
    rows = stage(plain, "mix-sizes")
    limits = _limits(rows, weights, share, most)
    return _with_copies(rows, limits, F.col(SIZE) > 0).select(
        id_column,
        *carry,
        F.col(SOURCE).alias("source"),
        F.col(SIZE).alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col(SIZE)).alias("taken"),
    )


def take(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """The documents with all their columns, each as often as the mixture takes it.

    The decisions are those of ``mix``. They depend on a row and on its source's limits, so
    they are made again in the row, and texts are neither written nor shuffled; only with
    too many sources to broadcast is there a join.
    """
    with scratch(docs.sparkSession):
        plain = docs.select(
            F.col(source).alias(SOURCE),
            count_words(F.col(text)).alias(SIZE),
            _hashed(id_column, text).alias(HASH),
        )
        limits = stage(_limits(stage(plain, "mix-sizes"), weights, share, most), "mix-taken", keep=True)
    rows = docs.select(
        F.struct(*[F.col(name) for name in docs.columns]).alias("__row"),
        F.col(source).alias(SOURCE),
        _hashed(id_column, text).alias(HASH),
        F.coalesce(F.col(text).rlike(NO_BLANK), F.lit(False)).alias("__some"),
    )
    taken = _with_copies(rows, limits, F.col("__some")).filter("copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("__row", again.alias("__copy")).select("__row.*")
