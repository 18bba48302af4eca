"""Gibberish by letter pairs: how surprising a text is for its language.

Training counts the pairs of neighbouring letters over a corpus. The counts are
summed per Arrow batch before the shuffle, so what travels is at most 729 numbers
per language and batch, however long the corpus is. Scoring needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import batches
from textguard.functions import text as tx

ALPHABET = " abcdefghijklmnopqrstuvwxyz"
PAIRS = [a + b for a in ALPHABET for b in ALPHABET]
MAX_LANGUAGES = 1000
MIN_LETTERS = 20
SLICE_CHARS = 2_000_000
REPEAT_SHARE = 0.2
GAP = len(ALPHABET)
CODES = np.full(128, GAP, dtype=np.int64)
CODES[[ord(letter) for letter in ALPHABET]] = range(len(ALPHABET))


def letters(text: Column) -> Column:
    """Lower-case letters, all else as single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z]+", " "))


def _pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pair number and text number of every pair, for texts written in ALPHABET."""
    codes = CODES[np.frombuffer("\n".join(texts).encode("ascii"), dtype=np.uint8)]
    first, second = codes[:-1], codes[1:]
    inside = (first != GAP) & (second != GAP)
    number = np.cumsum(codes == GAP)[:-1]
    return (first * GAP + second)[inside], number[inside]


def count_pairs(corpus: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, bigram, n) over the corpus."""

    def batch_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = batch["letters"].str.len().cumsum() // SLICE_CHARS
            for (name, _), texts in batch.groupby(["lang", cut.rename("cut")])["letters"]:
                counts = np.bincount(_pairs(texts.tolist())[0], minlength=len(PAIRS))
                seen = counts.nonzero()[0]
                if len(seen):
                    yield pd.DataFrame(
                        {"lang": name, "bigram": [PAIRS[i] for i in seen], "n": counts[seen]}
                    )

    prepared = corpus.select(F.col(lang).alias("lang"), letters(F.col(text)).alias("letters"))
    usable = prepared.filter(F.col("lang").isNotNull() & F.col("letters").isNotNull())
    partial = usable.mapInPandas(batch_counts, "lang string, bigram string, n long")
    return partial.groupBy("lang", "bigram").agg(F.sum("n").alias("n"))


def bigram_model(corpus: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, bigram, n, surprisal): bits per pair with add-one smoothing, for the
    pairs seen; the total over a language is on each of its rows."""
    counted = count_pairs(corpus, lang, text)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    probability = (F.col("n") + 1) / (F.col("total") + len(PAIRS))
    return counted.join(totals, "lang").select(
        "lang", "bigram", "n", "total", F.round(-F.log2(probability), 6).alias("surprisal")
    )


@dataclass(frozen=True)
class GibberishModel:
    """Bits per pair by language, and mean and spread over its sentences."""

    bits: dict[str, np.ndarray]
    stats: dict[str, tuple[float, float]]


def _mean_bits(parts: Column, lang: Column, bits: dict[str, np.ndarray]) -> Column:
    """Mean bits per pair for each string of an array; NULL for a string without pairs."""

    def scored(arrays: pa.Array, langs: pa.Array) -> pa.Array:
        out, start = [pa.array([], pa.list_(pa.float64()))], 0
        for lists in batches.slices(arrays, SLICE_CHARS, batches.chars):
            sizes, flat = batches.sizes(lists), lists.flatten().to_pylist()
            names = np.array(langs.slice(start, len(lists)).to_pylist(), dtype=object)
            start += len(lists)
            owner = np.repeat(names, sizes)
            means = np.full(len(flat), np.nan)
            for name, table in bits.items():
                chosen = np.flatnonzero(owner == name)
                pairs, number = _pairs([flat[i] for i in chosen])
                used = np.bincount(number, minlength=len(chosen))
                total = np.bincount(number, weights=table[pairs], minlength=len(chosen))
                means[chosen[used > 0]] = total[used > 0] / used[used > 0]
            values = pa.array(means, mask=np.isnan(means))
            out.append(batches.listed(values, sizes, np.ones(len(lists), bool)))
        return pa.concat_arrays(out)

    return F.arrow_udf(scored, "array<double>")(parts, lang)


def train_gibberish(corpus: DataFrame, lang: str, text: str) -> GibberishModel:
    """Learn the model; it has 729 numbers per language, so the driver may hold it."""
    counted = count_pairs(corpus, lang, text)
    wide = counted.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bigram", "n"))).alias("n"))
    learned = wide.limit(MAX_LANGUAGES + 1).collect()
    if len(learned) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    bits = {}
    for row in learned:
        counts = np.array([row.n.get(pair, 0) for pair in PAIRS], dtype=np.float64)
        bits[row.lang] = -np.log2((counts + 1) / (counts.sum() + len(PAIRS)))
    parts = F.transform(tx.sentences(F.col(text)), letters)
    long_parts = F.filter(parts, lambda part: F.length(part) > MIN_LETTERS)
    spread = (
        corpus.select(F.col(lang).alias("lang"), long_parts.alias("parts"))
        .select("lang", F.explode(_mean_bits(F.col("parts"), F.col("lang"), bits)).alias("bits"))
        .groupBy("lang")
        .agg(F.avg("bits").alias("mean"), F.stddev_pop("bits").alias("sd"))
        .collect()
    )
    return GibberishModel(bits, {row.lang: (row.mean, row.sd) for row in spread})


def _repeats(sentence: Column) -> Column:
    """Share of words that repeat the word before them."""

    def share(words: Column) -> Column:
        same = F.filter(words, lambda word, at: (at > 0) & (word == F.get(words, at - 1)))
        return F.coalesce(F.try_divide(F.size(same), F.size(words)), F.lit(0.0))

    return tx.bind(tx.words(sentence), share)


def gibberish(
    df: DataFrame,
    text: str,
    lang: str,
    model: GibberishModel,
    threshold: float = 0.5,
    match_type: str = "sentence",
    out: str = "scan",
) -> DataFrame:
    """Add the verdict: the most surprising part counts, the repair drops bad parts.

    The risk passes one half at four standard deviations above the mean of the
    language's sentences, and is 1 where a fifth of the words repeat their
    neighbour. A language without a model gets no verdict.
    """
    whole = F.col(text)
    units = tx.sentences(whole)
    if match_type == "full":
        units = F.when(whole.isNotNull(), F.array(whole))
    bits = _mean_bits(F.transform(units, letters), F.col(lang), model.bits)
    known = {name: stats for name, stats in model.stats.items() if stats[1]}
    mean, sd = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (center, width) in known.items():
        mean = F.when(F.col(lang) == name, center).otherwise(mean)
        sd = F.when(F.col(lang) == name, width).otherwise(sd)

    def risk(unit: Column, unit_bits: Column) -> Column:
        odds = 1 / (1 + F.exp(4 - (unit_bits - F.col("__mean")) / F.col("__sd")))
        scored = F.when(unit_bits.isNull(), 0.0).otherwise(odds)
        repeated = F.when(_repeats(unit) >= REPEAT_SHARE, 1.0)
        return F.when(F.col("__mean").isNotNull(), F.round(F.coalesce(repeated, scored), 6))

    scored = (
        df.withColumns({"__units": units, "__mean": mean, "__sd": sd, "__bits": bits})
        .withColumn("__risks", F.zip_with("__units", "__bits", risk))
        .withColumn(
            "__risk",
            F.when(
                whole.isNotNull() & F.col("__mean").isNotNull(),
                F.coalesce(F.array_max("__risks"), F.lit(0.0)),
            ),
        )
    )
    kept = F.filter("__units", lambda _, at: F.get("__risks", at) < threshold)
    verdict = F.struct(
        F.when(F.col("__risk") < threshold, whole)
        .when(F.col("__risk").isNotNull(), tx.join_sentences(kept))
        .alias("sanitized"),
        (F.col("__risk") < threshold).alias("is_valid"),
        F.col("__risk").alias("risk_score"),
    )
    return scored.withColumn(out, verdict).drop("__units", "__mean", "__sd", "__bits", "__risks", "__risk")
