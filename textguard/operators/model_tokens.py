"""Limits and chunks in the tokens of a model: byte-pair vocabularies from a file of ranks.

Texts are cut into pieces by the JVM; tasks encode pieces with the ranks, which come once per
executor as a broadcast. A text never leaves its row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from textguard.functions import batches, bpe
from textguard.functions import text as tx
from textguard.operators.rule import Rule, flag

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNKS = "array<struct<chunk:string,n_tokens:int>>"
SLICE_PIECES = 100_000
# One encoder per worker process and vocabulary: its memo outlives a batch.
_encoders: dict[int, bpe.Encoder] = {}


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of a file, sent to the executors once. A path with a scheme is read by
    Spark, any other one on the driver."""
    if "://" in path:
        lines = [row.value for row in spark.read.text(path).toLocalIterator()]
    else:
        with open(path, encoding="ascii") as file:
            lines = list(file)
    return spark.sparkContext.broadcast(bpe.parse_ranks(lines))


def pieces(text: Column) -> Column:
    return tx.extract(text, bpe.PIECE)


def _encoder(held: Broadcast) -> bpe.Encoder:
    ranks = held.value
    if id(ranks) not in _encoders:
        _encoders.clear()
        _encoders[id(ranks)] = bpe.Encoder(ranks)
    return _encoders[id(ranks)]


def _per_text(kind: str, arrow: pa.DataType, held: Broadcast, make: Callable) -> Callable[[Column], Column]:
    def run(column: pa.Array) -> pa.Array:
        encoder = _encoder(held)
        out = [pa.array([], arrow)]
        for texts in batches.slices(column, SLICE_PIECES):
            made = [None if text is None else make(encoder, text) for text in texts.to_pylist()]
            out.append(pa.array(made, arrow))
        return pa.concat_arrays(out)

    udf = F.arrow_udf(run, kind)
    return lambda text: udf(pieces(text))


def token_ids(held: Broadcast) -> Callable[[Column], Column]:
    """A column function: the ids of a text."""

    def make(encoder: bpe.Encoder, cut: list[str]) -> list[int]:
        return [number for piece in cut for number in encoder.ids(piece)]

    return _per_text("array<int>", pa.list_(pa.int32()), held, make)


def model_chunks(held: Broadcast, limit: int) -> Callable[[Column], Column]:
    """A column function: the whole text as chunks of at most ``limit`` tokens.

    Chunks end between pieces; a piece of more tokens than that is halved until its parts
    fit. A single character is never cut, whatever its number of tokens.
    """

    def make(encoder: bpe.Encoder, cut: list[str]) -> list[dict]:
        return [{"chunk": chunk, "n_tokens": n} for chunk, n in encoder.chunks(cut, limit)]

    arrow = pa.list_(pa.struct([("chunk", pa.string()), ("n_tokens", pa.int32())]))
    return _per_text(CHUNKS, arrow, held, make)


def model_token_limit(held: Broadcast, limit: int) -> Rule:
    """At most ``limit`` tokens of the vocabulary; the repair keeps the first chunk.

    NULL texts have no verdict and empty ones no tokens.
    """

    def make(encoder: bpe.Encoder, cut: list[str]) -> dict:
        total = sum(len(encoder.ids(piece)) for piece in cut)
        first = encoder.chunks(cut, limit)[0][0] if total > limit else None
        return {"n_tokens": total, "first": first}

    arrow = pa.struct([("n_tokens", pa.int64()), ("first", pa.string())])
    measure = _per_text("struct<n_tokens:bigint,first:string>", arrow, held, make)
    return Rule(
        "model_token_limit",
        lambda found: flag(found["n_tokens"] > limit),
        measure=measure,
        details={"n_tokens": lambda found: found["n_tokens"]},
        repair=lambda text, found: found["first"],
    )
