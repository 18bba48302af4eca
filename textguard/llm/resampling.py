"""Importance resampling towards a target text: hashed n-gram buckets and Gumbel draws."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.llm.bytehash import BREAKS, LOWER, chunks, text_buffers
from textguard.llm.common import numbered, shuffles_dropped
from textguard.llm.crc import PositionTable
from textguard.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
WORDS_AT_ONCE = 1 << 17
Batches = Iterator[pa.RecordBatch]


def _features(
    data: np.ndarray, offsets: np.ndarray, table: PositionTable, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of each word and each pair of neighbouring words, lower-cased.

    The words of a stretch are copied into one array with a space between neighbours,
    where every feature is one span; a stretch begins with the last word of the one
    before, so that a long text may be cut anywhere between words.
    """
    solid = ~BREAKS[data]
    heads = solid.copy()
    heads[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    heads[inner] = solid[inner]
    tails = solid.copy()
    tails[:-1] &= ~solid[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    tails[ends] = solid[ends]
    starts, stops = np.flatnonzero(heads), np.flatnonzero(tails) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    for low in range(0, len(starts), WORDS_AT_ONCE):
        first, last = max(0, low - 1), min(len(starts), low + WORDS_AT_ONCE)
        begin, size = starts[first:last], stops[first:last] - starts[first:last]
        to = np.cumsum(size + 1) - size - 1
        joined = np.full(int(to[-1] + size[-1]), 32, np.uint8)
        part = slice(int(begin[0]), int(stops[last - 1]))
        joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = LOWER[
            data[part][solid[part]]
        ]
        texts = owner[first:last]
        fresh = slice(low - first, None)
        paired = np.flatnonzero(texts[1:] == texts[:-1])
        span_starts = np.concatenate([to[fresh], to[paired]])
        span_ends = np.concatenate([(to + size)[fresh], (to + size)[paired + 1]])
        crc = table.crc32(joined, span_starts, span_ends)
        yield np.concatenate([texts[fresh], texts[paired]]), crc % buckets


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(column)
    for low, high in chunks(offsets):
        first, last = int(offsets[low]), int(offsets[high])
        yield low, high, data[first:last], (offsets[low : high + 1] - first).astype(np.int64)


def _counter(buckets: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table, counts = PositionTable(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in _pieces(batch.column(0)):
                for _, bucket in _features(data, offsets, table, buckets):
                    counts += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket over all texts; a task gives at most one row a bucket."""
    filled = texts.select(F.coalesce(F.col(text), F.lit("")))
    counted = filled.mapInArrow(_counter(buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln of the smoothed ratio of shares) per bucket, from two tables of counts.

    The tables have at most a row per bucket, so that is also all the driver gets.
    """
    both = (
        source.sparkSession.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(source.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(name, F.lit(0)).cast("double").alias(name) for name in "st"])
    )
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    up = (F.col("t") + 1) * (all_s + buckets)
    down = (F.col("s") + 1) * (all_t + buckets)
    gains = both.select("bucket", F.floor(1000 * F.ln(up / down)).alias("gain"))
    out = [0] * buckets
    for row in gains.toLocalIterator():
        out[row.bucket] = row.gain
    return out


def _weigher(gains: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table, buckets = PositionTable(), len(gains)
        for batch in batches:
            counts = np.zeros(len(batch), np.int64)
            sums = np.zeros(len(batch), np.int64)
            words = np.zeros(len(batch), np.int64)
            for low, high, data, offsets in _pieces(batch.column("text")):
                for owner, bucket in _features(data, offsets, table, buckets):
                    counts[low:high] += np.bincount(owner, minlength=high - low)
                    # Whole numbers below 2 ** 53, so that the sums of doubles are exact.
                    sums[low:high] += np.bincount(
                        owner, weights=gains[bucket], minlength=high - low
                    ).astype(np.int64)
            words = (counts + 1) // 2
            weights = np.where(counts > 0, sums // np.maximum(counts, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), pa.array(words), pa.array(weights)],
                ["id", "n_features", "n_words", "weight"],
            )

    return run


def gumbel(seed: int, row_id: Column) -> Column:
    """floor(1000 g) of standard Gumbel noise that depends on the seed and the id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((number + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 25,
    min_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Draw the share of documents that look most like the target: ``n_features``, ``weight``,
    ``score``, ``rank``.

    Features are words and pairs of neighbouring words, hashed to buckets by the CRC-32 of
    their bytes. A bucket's gain is the log of its share in the target over its share in
    the documents. A document's weight is the floored mean of the gains over its features, its
    score the weight plus Gumbel noise, and the documents of the highest scores are a draw
    without replacement by weight. Texts are read twice, once to count and once to weigh,
    because their bucket lists would be larger than they are; both passes are narrow, and
    what is shuffled is one row per bucket and task, and then one short row per document.
    Ranks come from range partitions and their sizes, not from one sorted task.

    Defined cases: NULL and empty texts have no features, weight 0 and no rank unless
    ``min_words`` is 0; texts of any length are cut between words and summed. A NULL id
    is hashed as ``null`` and comes last among equal scores; repeated rows are drawn each
    on its own, with equal noise. An empty target has no counts, an empty table
    gives an empty table. Other columns come back only if named in ``carry``.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    with shuffles_dropped(spark):
        source_counts = stage(bucket_counts(docs, text, buckets), "resample-source")
        target_counts = stage(bucket_counts(target, target_text, buckets), "resample-target")
        gains = np.array(bucket_gains(source_counts, target_counts, buckets), np.float64)
        extra = F.struct(*[F.col(name) for name in carry]) if carry else F.lit(None).cast("string")
        plain = docs.select(
            F.struct(F.col(doc_id).alias("of"), extra.alias("with")).alias("id"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        id_kind = plain.schema["id"].dataType.simpleString()
        weighed = plain.mapInArrow(
            _weigher(gains), f"id {id_kind}, n_features long, n_words long, weight long"
        )
        weighed = weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("id.of")))
        rows = stage(weighed, "resample-weighed")
        enough = F.col("n_words") >= min_words
        drawn = rows.agg(F.coalesce(F.floor(F.count_if(enough) * percent / 100), F.lit(0))).scalar()
        ties = [F.col("id.of").isNull(), F.col("id.of"), F.col("weight"), F.col("n_features")]
        order = [~enough, -F.col("score"), *ties]
        ranked = stage(numbered(rows, order, "place"), "resample-ranked")
    return ranked.select(
        F.col("id.of").cast(kind).alias(doc_id),
        *[F.col("id.with")[name].alias(name) for name in carry],
        "n_features",
        "weight",
        "score",
        F.when(enough & (F.col("place") < drawn), F.col("place") + 1).alias("rank"),
    )
