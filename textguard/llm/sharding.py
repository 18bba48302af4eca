"""Placing rows on shards with a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.llm.common import number_hash

SLOTS = 16381
SHARDS = tuple(f"shard-{number:03d}" for number in range(64))


def _is_prime(number: int) -> bool:
    return number > 1 and all(number % d for d in range(2, int(number**0.5) + 1))


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def slot_owners(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> list[str]:
    """The owner of each slot.

    A shard's preference order is a permutation of the slots, given by a start and
    a stride that come from its name; the number of slots is prime, so every stride
    visits all of them. The shards take turns, each claiming the first free slot
    in its order, until all slots are taken. The table depends on the names and the
    number of slots alone, both parameters, and never on data.
    """
    names = sorted(set(shards))
    if not _is_prime(slots) or slots < len(names) or not names:
        raise ValueError("the number of slots must be prime and not below the number of shards")
    starts = [_digest(f"start:{name}") % slots for name in names]
    strides = [_digest(f"stride:{name}") % (slots - 1) + 1 for name in names]
    owners: list[str | None] = [None] * slots
    for turn in range(slots):
        shard = turn % len(names)
        while owners[starts[shard]] is not None:
            starts[shard] = (starts[shard] + strides[shard]) % slots
        owners[starts[shard]] = names[shard]
    return owners  # type: ignore[return-value]


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """(slot, shard), one row per slot; a few hundred KB at most, so it is always broadcast."""
    owned = ",".join(slot_owners(shards, slots))
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(owned), ",")).alias("__slot", "shard")
    )


def place(
    df: DataFrame,
    key: str = "doc_id",
    shards: Sequence[str] = SHARDS,
    slots: int = SLOTS,
) -> DataFrame:
    """Add ``slot`` and ``shard`` to every row.

    The slot is a hash of the key modulo the number of slots; its owner is looked up
    in the broadcast table, so no row is shuffled. When a shard leaves, its slots go to
    the others and few other slots change hands.

    Defined cases: rows with equal keys land on one shard; NULL keys all take the
    slot of the word "null"; columns named slot or shard are replaced; an empty
    table stays empty. Shard names must not contain commas.
    """
    if any("," in name for name in shards):
        raise ValueError("shard names must not contain commas")
    table = lookup_table(df.sparkSession, shards, slots)
    hashed = number_hash(F.lit("shard:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    rows = df.drop(*[name for name in ("slot", "shard") if name != key]).withColumn(
        "__slot", F.pmod(hashed, F.lit(slots)).cast("int")
    )
    joined = rows.join(F.broadcast(table), "__slot", "left")
    return joined.withColumn("slot", F.col("__slot")).drop("__slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; each task appends to the shards it holds rows of."""
    placed.write.partitionBy("shard").parquet(path)
