"""Multinomial naive Bayes over exploded features, in plain aggregates.

Chances are kept as whole thousandths of their natural logarithm, rounded down once per
feature and label, so sums are exact in any order and SQL gives the same numbers.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import batches
from textguard.functions import text as tx
from textguard.plans.skew import spread_join
from textguard.session import scratch, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
GRAM = 3
PROFILE_GAINS = 20_000_000
SLICE_CHARS = 500_000


class Model(NamedTuple):
    """``gains`` (feature, entries): per label what a feature adds to the score of one that was
    never seen with it, and how often it was seen; ``labels`` (label, unseen): what such a one
    scores."""

    gains: DataFrame
    labels: DataFrame


def train(features: DataFrame, label: str = "label", feature: str = "feature") -> Model:
    """Count each feature under each label; with one added to each count.

    Rows without a label or a feature are left out. The model has one row per feature, however many
    texts there are.
    """
    known = features.filter(F.col(label).isNotNull() & F.col(feature).isNotNull())
    with scratch(features.sparkSession):
        counts = known.groupBy(F.col(label).alias("label"), F.col(feature).alias("feature"))
        counts = stage(counts.agg(F.count(F.lit(1)).alias("n")), "bayes-counts")
        width = counts.select(F.count_distinct("feature")).scalar()
        sums = counts.groupBy("label").agg(F.sum("n").alias("total"))
        sums = stage(sums.withColumn("size", F.col("total") + width), "bayes-sums")
        unseen = F.floor(1000 * F.ln(1 / F.col("size"))).cast("long")
        labels = stage(sums.select("label", unseen.alias("unseen")), "bayes-labels", keep=True)
        chance = F.floor(1000 * F.ln((F.col("n") + 1) / F.col("size"))).cast("long")
        gains = counts.join(F.broadcast(sums), "label").select(
            "feature", F.struct("label", (chance - unseen).alias("gain"), "n").alias("entry")
        )
        gains = gains.groupBy("feature").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        return Model(stage(gains, "bayes-gains", keep=True), labels)


def scores(features: DataFrame, sizes: DataFrame, model: Model, key: str) -> DataFrame:
    """(key, label, score) for every row of ``sizes`` (key, n) and every label.

    Features meet the model in a broadcast or, where it is longer, a join that spreads frequent
    features; only sums per key and label are shuffled after that.
    """

    def counts() -> tuple[DataFrame, str]:
        return features.groupBy("feature").agg(F.count(F.lit(1)).alias("n")), "n"

    met = spread_join(features, model.gains, "feature", counts, [key])
    return _totals(met.select(key, F.inline("entries")), sizes, model, key)


def _totals(gains: DataFrame, sizes: DataFrame, model: Model, key: str) -> DataFrame:
    """(key, label, score) from (key, label, gain) rows."""
    gained = gains.groupBy(key, "label").agg(F.sum("gain").alias("gain"))
    listed = model.labels.agg(F.array_sort(F.collect_list(F.struct("label", "unseen")))).scalar()
    every = sizes.select(key, "n", F.inline(listed))
    score = F.coalesce("gain", F.lit(0)) + F.col("n") * F.col("unseen")
    return every.join(gained, [key, "label"], "left").select(key, "label", score.cast("long").alias("score"))


def _plain(text: Column) -> Column:
    """The lower-cased text in which all but letters is one space, between two of them."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))
    return F.regexp_replace(plain, " +", " ")


def _letters(text: Column) -> Column:
    return F.split(_plain(text), "")


def _count_grams(text: Column) -> Column:
    return F.coalesce(F.greatest(F.length(_plain(text)) - (GRAM - 1), F.lit(0)), F.lit(0))


def letter_grams(text: Column) -> Column:
    """Every run of three characters, as often as it occurs."""

    def cut(chars: Column) -> Column:
        return F.when(
            F.size(chars) >= GRAM,
            F.transform(
                F.sequence(F.lit(0), F.size(chars) - GRAM),
                lambda at: F.concat(*[F.get(chars, at + step) for step in range(GRAM)]),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return F.coalesce(tx.bind(_letters(text), cut), F.array().cast("array<string>"))


def language_profiles(df: DataFrame, text: str, lang: str) -> Model:
    """Profiles of any number of languages from texts whose language is known."""
    return train(df.select(F.col(lang).alias("label"), F.explode(letter_grams(F.col(text))).alias("feature")))


def _codes(texts: list[str]) -> np.ndarray:
    """Every run of three characters of the joined texts as one number."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def _gains_per_text(model: Model, names: list[str]):
    """A column function from plain texts to what their runs add under each label. The tasks get the
    whole model: a number and a gain per label for each run."""
    rows = model.gains.select("feature", F.map_from_arrays("entries.label", "entries.gain").alias("gains")).collect()
    codes = _codes([row.feature for row in rows])[::GRAM]
    order = np.argsort(codes)
    gains = np.array([[row.gains.get(name, 0) for row in rows] for name in names], np.int32).reshape(len(names), -1)
    held = model.gains.sparkSession.sparkContext.broadcast((codes[order], gains[:, order]))

    def score(column: pa.Array) -> pa.Array:
        known, gains = held.value
        out = [pa.array([], pa.list_(pa.int64()))]
        for part in batches.slices(column, SLICE_CHARS, _bytes):
            texts = [text or "" for text in part.to_pylist()]
            ends = np.cumsum([len(text) for text in texts])
            sums = np.zeros((len(texts), len(gains)), np.int64)
            runs = _codes(texts)
            if len(runs) and len(known):
                row = np.searchsorted(ends, np.arange(len(runs)), "right")
                at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                hit = np.flatnonzero((known[at] == runs) & (np.arange(len(runs)) + GRAM <= ends[row]))
                for number, gain in enumerate(gains):
                    sums[:, number] = np.bincount(row[hit], gain[at[hit]], len(texts)).astype(np.int64)
            count = np.full(len(texts), len(gains))
            out.append(batches.listed(pa.array(sums.ravel()), count, np.ones(len(texts), bool)))
        return pa.concat_arrays(out)

    return F.arrow_udf(score, "array<bigint>")


def _bytes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _profile_scores(rows: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``scores`` of runs of letters, added up in the tasks if the model fits there."""
    sizes = rows.select(key, _count_grams(F.col(text)).cast("long").alias("n"))
    names = [row.label for row in model.labels.select("label").limit(PROFILE_GAINS).collect()]
    if not names or model.gains.count() * len(names) > PROFILE_GAINS:
        features = rows.select(key, F.explode(letter_grams(F.col(text))).alias("feature"))
        return scores(features, sizes, model, key)
    gains = rows.select(key, _gains_per_text(model, names)(_plain(F.col(text))).alias("gains"))
    kind = model.labels.schema["label"].dataType
    labels = F.array(*[F.lit(name).cast(kind) for name in names])
    listed = F.arrays_zip(labels.alias("label"), F.col("gains").alias("gain"))
    return _totals(gains.select(key, F.inline(listed).alias("label", "gain")), sizes, model, key)


def detect_by_profile(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, lang, margin): the likeliest language and how far it leads, in nats per run of letters.

    Equal scores go to the first label of the alphabet. A text without three
    characters is of unknown language; a NULL one has none.
    """
    grams = _count_grams(F.col(text))
    found = _profile_scores(df.filter(F.col(text).isNotNull()), key, text, model)
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "label")))
    ranked = found.groupBy(key).agg(order.alias("ranked"))
    lead = F.get("ranked", F.lit(1))["minus"] - F.get("ranked", F.lit(0))["minus"]
    joined = df.select(key, grams.alias("n"), F.col(text).isNotNull().alias("known")).join(ranked, key, "left")
    some = F.col("known") & (F.col("n") > 0) & F.col("ranked").isNotNull()
    return joined.select(
        key,
        F.when(some, F.get("ranked", F.lit(0))["label"]).when(F.col("known"), UNKNOWN).alias("lang"),
        F.when(some, F.round(F.coalesce(lead, F.lit(0)) / (1000 * F.col("n")), 6))
        .when(F.col("known"), 0.0)
        .alias("margin"),
    )


def word_features(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Each word of each text once, so that a repeated word is one piece of evidence."""
    listed = F.array_distinct(F.coalesce(tx.words(F.col(text)), F.array().cast("array<string>")))
    return df.select(*keep, F.explode(listed).alias("feature"))


def train_toxicity(labelled: DataFrame, text: str, label: str) -> Model:
    """Chances of words in texts of label 1 and of label 0."""
    return train(word_features(labelled, text, label), label)


def toxicity_by_words(
    df: DataFrame,
    key: str,
    text: str,
    model: Model,
    threshold: float = 0.5,
    least: int = 5,
    strength: int = 2000,
    prior: int = -2000,
) -> DataFrame:
    """(key, is_valid, risk_score): the chance of label 1 against label 0.

    Evidence are words that at least ``least`` texts of label 1 hold and whose odds for it are
    ``strength`` thousandths of a nat or more; the many words that lean to a side by chance would
    outweigh them in a long text. ``prior`` are the odds of a text without evidence. Models that
    lack a label have no evidence; NULL texts have no verdict.
    """
    feature = word_features(df.filter(F.col(text).isNotNull()), text, key)
    bases = model.labels.agg(
        *[F.max(F.when(F.col("label") == value, F.col("unseen"))).alias(name) for value, name in ((1, "one"), (0, "zero"))]
    ).first()
    both = bases.one is not None and bases.zero is not None
    base = bases.one - bases.zero if both else 0

    def gain(value: int) -> Column:
        mine = F.filter("entries", lambda entry: entry["label"] == value)
        return F.coalesce(F.get(mine, F.lit(0))["gain"], F.lit(0))

    toxic = F.filter("entries", lambda entry: (entry["label"] == 1) & (entry["n"] >= least))
    odds = model.gains.filter(F.size(toxic) > 0).select("feature", (gain(1) - gain(0) + base).alias("odds"))
    odds = odds.filter(F.lit(both) & (F.col("odds") >= strength))

    def counts() -> tuple[DataFrame, str]:
        return feature.groupBy("feature").agg(F.count(F.lit(1)).alias("n")), "n"

    with scratch(df.sparkSession):
        met = spread_join(feature, stage(odds, "bayes-odds"), "feature", counts, [key])
        summed = met.groupBy(key).agg(F.sum("odds").alias("odds"))
        summed = stage(summed, "bayes-summed", keep=True)
    joined = df.select(key, F.col(text).isNotNull().alias("known")).join(summed, key, "left")
    odds_of = F.coalesce("odds", F.lit(0)) + prior
    clipped = F.greatest(F.least(odds_of / 1000, F.lit(30.0)), F.lit(-30.0))
    risk = F.when(F.col("known"), F.round(1 / (1 + F.exp(-clipped)), 6))
    return joined.select(key, (risk < threshold).alias("is_valid"), risk.alias("risk_score"))
