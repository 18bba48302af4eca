"""Removing repeated substrings: winnowed fingerprints, then hashes of the full length."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.llm.bytehash import RollingHash, pieces, sliding_minimum, text_buffers
from textguard.llm.common import shuffles_dropped
from textguard.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 100
GRAM = 48
PLACE = np.uint64((1 << 23) - 1)
NO_ID = (1 << 63) - 1
Batches = Iterator[pa.RecordBatch]


def _repeated_before(keys: np.ndarray) -> np.ndarray:
    """Whether the same key stands earlier in the array."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return same


def suffix_runs(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, ...]:
    """(row, start, count, bucket, whole): the substrings of ``length`` bytes in runs.

    The bucket of a substring is the hash of its smallest gram, the leftmost of equals,
    which two equal substrings hold at one place. Neighbouring substrings around one such
    gram are a run, so no run holds a substring twice; ``whole`` is the hash of all the
    bytes that the run's substrings cover. The order of grams is that of their upper
    hash bits; the lower ones hold the place.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for low, high, first, last in pieces(offsets, length - 1):
        part = data[first:last]
        if len(part) < length:
            continue
        rolling = RollingHash(part)
        grams = rolling.all(gram)
        ranked = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        smallest = sliding_minimum(ranked, length - gram + 1) & PLACE
        places = np.clip(offsets[low : high + 1] - first, 0, len(part))
        sizes = np.diff(places)
        row = np.repeat(np.arange(low, high), sizes)[: len(smallest)]
        end = np.repeat(places[1:], sizes)[: len(smallest)]
        head = np.ones(len(smallest), bool)
        head[1:] = (smallest[1:] != smallest[:-1]) | (row[1:] != row[:-1])
        head &= np.arange(len(smallest)) + length <= end
        starts = np.flatnonzero(head)
        stops = np.minimum(np.append(starts[1:], len(smallest)), end[starts] - length + 1)
        whole = rolling.of(starts, stops + (length - 1))
        rows = row[starts]
        bucket = grams[smallest[starts].astype(np.int64)]
        found.append((rows, starts + first - offsets[rows], stops - starts, bucket, whole))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(columns) for columns in zip(*found, strict=True))


def _keys_of(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    picked = pa.array(rows)
    return [batch.column("id").take(picked), batch.column("key").take(picked)]


def _run_finder(length: int, gram: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            rows, starts, counts, buckets, wholes = suffix_runs(data, offsets, length, gram)
            salted = wholes * np.uint64(0x9E3779B97F4A7C15) + rows.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    *_keys_of(batch, rows),
                    pa.array(starts.astype(np.int32)),
                    pa.array(counts.astype(np.int32)),
                    pa.array(buckets.view(np.int64)),
                    pa.array(wholes.view(np.int64)),
                    pa.array(_repeated_before(salted)),
                ],
                ["id", "key", "start", "n", "bucket", "whole", "later"],
            )

    return run


def _bucket_finder(length: int, gram: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            buckets = suffix_runs(data, offsets, length, gram)[3]
            yield pa.RecordBatch.from_arrays([pa.array(buckets.view(np.int64))], ["bucket"])

    return run


def _listed(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    spans = batch.column("spans")[row].values
    if spans is None or len(spans) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = spans.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
    return starts, spans.field("n").to_numpy(zero_copy_only=False).astype(np.int64)


def _refiner(length: int) -> Callable[[Batches], Batches]:
    """Each listed run falls into its substrings, under buckets refined to their full
    length; of those that repeat inside a row only the first is kept as not ``later``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            listed = [_listed(batch, row) for row in range(len(batch))]
            sizes = [len(starts) for starts, _ in listed]
            rows = np.repeat(np.arange(len(batch)), sizes)
            starts = np.concatenate([s for s, _ in listed] or [np.zeros(0, np.int64)])
            counts = np.concatenate([n for _, n in listed] or [np.zeros(0, np.int64)])
            order = np.lexsort((starts, rows))
            rows, begin, counts = rows[order], (starts + offsets[rows])[order], counts[order]
            each = np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            owner = np.repeat(rows, counts)
            hashes = np.zeros(len(each), np.uint64)
            for _, _, first, last in pieces(offsets, length - 1):
                low, high = np.searchsorted(each, [first, last - length + 1])
                if low < high:
                    refined = RollingHash(data[first:last])
                    hashes[low:high] = refined.of(
                        each[low:high] - first, each[low:high] - first + length
                    )
            salted = hashes * np.uint64(0x9E3779B97F4A7C15) + owner.astype(np.uint64)
            for at in range(0, len(each), 500_000):
                part = slice(at, at + 500_000)
                if at == 0:
                    later = _repeated_before(salted)
                yield pa.RecordBatch.from_arrays(
                    [
                        *_keys_of(batch, owner[part]),
                        pa.array((each[part] - offsets[owner[part]]).astype(np.int32)),
                        pa.array(hashes[part].view(np.int64)),
                        pa.array(later[part]),
                    ],
                    ["id", "key", "start", "whole", "later"],
                )

    return run


def _remover(length: int, with_kept: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            removed, spans, digests, kept = [], [], [], []
            for row in range(len(batch)):
                body = data[offsets[row] : offsets[row + 1]]
                starts, counts = _listed(batch, row)
                merged: list[dict[str, int]] = []
                if len(starts):
                    order = np.argsort(starts)
                    begin, stop = starts[order], (starts + counts)[order] + length - 1
                    reach = np.maximum.accumulate(stop)
                    heads = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
                    lasts = np.append(heads[1:], len(begin)) - 1
                    merged = [
                        {"start": int(begin[h]), "end": int(reach[t])}
                        for h, t in zip(heads, lasts, strict=True)
                    ]
                    edges = [0, *[edge for m in merged for edge in (m["start"], m["end"])], len(body)]
                    left = b"".join(
                        body[edges[k] : edges[k + 1]].tobytes() for k in range(0, len(edges), 2)
                    )
                else:
                    left = body.tobytes()
                removed.append(len(body) - len(left))
                spans.append(merged)
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_kept else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(
                        spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    ),
                    pa.array(kept, pa.binary()),
                ],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    return run


def _with_spans(texts: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Each text with the list of its own spans, which is no longer than the text."""
    lists = spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return texts.join(lists, ["id", "key"], how)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    with_kept: bool = False,
) -> DataFrame:
    """Remove each byte in a substring of ``length`` bytes that also starts earlier.

    Winnowed fingerprints and hashes of the full length take the place of bucket pointers
    that are sorted on the bucket identifiers of later offsets:

    1. Initial buckets: each substring of ``length`` bytes is put in the bucket of its
       smallest gram of ``gram`` bytes. Runs of neighbours in one bucket are one entry, about
       one for 28 bytes. Buckets with one entry are final and drop out.
    2. Whole runs: entries are grouped by a hash of all bytes they cover. In an entry
       equal to an earlier one all substrings are repeats.
    3. Windows: where a bucket still holds different entries, the first of each falls into
       its substrings of ``length`` bytes, grouped by a hash of their own; those equal
       to an earlier one are repeats.

    Within a document the earlier occurrence is found in its row, across documents by the
    smallest id of a bucket, with partial aggregation; frequent buckets meet their
    entries in joins that split such keys. Each step ends in a written table.
    Buckets are named by 64-bit hashes of their bytes: a chance match of two of n entries
    has odds of n * n / 2 ** 65.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, the removed ``spans``
    (byte offsets) and, if asked for, the ``kept`` bytes, which may be cut within a character.

    Defined cases: NULL and empty texts have no bytes; texts shorter than ``length`` are
    kept whole; rows with one id are the same place in the order, so none of them is
    earlier than another, and each is compared with itself and with smaller ids; NULL ids come last;
    other columns play no part; an empty table gives an empty table.
    """
    if not 1 <= gram <= length:
        raise ValueError("a gram must fit in the length")
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.hash(F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    with shuffles_dropped(spark):
        buckets = texts.select("text").mapInArrow(_bucket_finder(length, gram), "bucket long")
        counted = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        shared = stage(counted.filter("n > 1").select("bucket"), "repeat-buckets")

        schema = "id long, key int, start int, n int, bucket long, whole long, later boolean"
        runs = texts.select("id", "key", "text").mapInArrow(_run_finder(length, gram), schema)
        entries = stage(runs.join(shared, "bucket", "left_semi"), "repeat-entries")

        firsts = entries.groupBy("bucket", "whole").agg(F.min("id").alias("first"))
        kinds = stage(firsts, "repeat-firsts")
        split = stage(
            kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"),
            "repeat-split",
        )
        kinds = kinds.join(split, "bucket", "left")
        judged = stage(
            entries.join(kinds, ["bucket", "whole"]).select(
                "id",
                "key",
                "start",
                "n",
                (F.col("later") | (F.col("id") > F.col("first"))).alias("repeat"),
                F.col("kinds").isNotNull().alias("open"),
            ),
            "repeat-judged",
        )
        unsettled = judged.filter(F.col("open") & ~F.col("repeat"))
        schema = "id long, key int, start int, whole long, later boolean"

        def refined() -> DataFrame:
            rows = _with_spans(texts.select("id", "key", "text"), unsettled, "inner")
            return rows.mapInArrow(_refiner(length), schema)

        earliest = (
            refined()
            .groupBy("whole")
            .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
        )
        earliest = stage(earliest.select("whole", "first"), "repeat-earliest")
        met = refined().join(earliest, "whole")
        deep = stage(
            met.filter(F.col("later") | (F.col("id") > F.col("first"))).select(
                "id", "key", "start", F.lit(1).alias("n")
            ),
            "repeat-deep",
        )
        spans = judged.filter("repeat").select("id", "key", "start", "n").union(deep)
        schema = (
            "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "spans array<struct<start:long,end:long>>, kept binary"
        )
        removed = _with_spans(texts, spans, "left").mapInArrow(_remover(length, with_kept), schema)
        result = stage(removed, "repeat-removed")
    return result.withColumnRenamed("doc", id_column)
