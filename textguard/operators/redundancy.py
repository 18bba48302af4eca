"""Sentences that repeat an earlier sentence of the same text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.session import broadcast_if_small, stage


def _token_set(sentence: Column) -> Column:
    """Distinct words, long ones first: any fixed order makes the prefix filter
    exact, and long words are rare enough to make it sharp."""
    ranked = F.transform(
        F.array_distinct(tx.words(sentence)),
        lambda w: F.struct((-F.length(w)).alias("shortness"), w.alias("word")),
    )
    return F.transform(F.sort_array(ranked), lambda r: r["word"])


def _prefix(words: Column, threshold: float) -> Column:
    """Two sets of that Jaccard similarity share a word in these leading parts."""
    needed = F.ceil(F.size(words) * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return F.slice(words, 1, F.size(words) - needed + 1)


def _repeated(items: Column) -> Column:
    def same_as_before(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, at: (at > 0) & (x == F.get(ordered, at - 1)))

    return F.array_distinct(tx.bind(F.sort_array(items), same_as_before))


def _linked(text: Column, threshold: float) -> Column:
    """The sentences of one text that share a prefix word with another one."""

    def links(sets: Column, shared: Column) -> Column:
        every = F.transform(
            sets,
            lambda words, at: F.struct(
                at.alias("pos"),
                words.alias("words"),
                F.array_intersect(_prefix(words, threshold), shared).alias("links"),
            ),
        )
        return F.filter(every, lambda one: F.size(one["links"]) > 0)

    def linked(sets: Column) -> Column:
        prefixes = F.transform(sets, lambda words: _prefix(words, threshold))
        return tx.bind(_repeated(F.flatten(prefixes)), lambda shared: links(sets, shared))

    return tx.bind(F.transform(tx.sentences(text), _token_set), linked)


def redundant_positions(
    df: DataFrame, key: str, text: str, threshold: float = 0.7
) -> DataFrame:
    """(key, pos) of the sentences whose word set has a Jaccard similarity of at
    least ``threshold`` with that of an earlier sentence of the text.

    Most texts and sentences drop out inside their own row: only sentences that
    share a prefix word with another sentence of the text are exploded. Equal
    word sets are merged before the join, so repeats make no pairs.
    """
    sentences = df.select(key, F.inline_outer(_linked(F.col(text), threshold))).filter(
        F.col("pos").isNotNull()
    )
    distinct = sentences.groupBy(key, "words").agg(
        F.first("links").alias("links"),
        F.min("pos").alias("first_pos"),
        F.collect_list("pos").alias("positions"),
    )
    distinct = stage(distinct, "repeats")
    links = distinct.select(
        key, "words", "first_pos", F.size("words").alias("n"), F.explode("links").alias("link")
    )
    earlier, later = links.alias("a"), links.alias("b")
    common = F.size(F.array_intersect("a.words", "b.words"))
    similar = (
        earlier.join(
            later,
            (F.col(f"a.{key}") == F.col(f"b.{key}"))
            & (F.col("a.link") == F.col("b.link"))
            & (F.col("a.first_pos") < F.col("b.first_pos"))
            & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * F.lit(threshold - 1e-9)),
        )
        .filter(common / (F.col("a.n") + F.col("b.n") - common) >= threshold)
        .select(F.col(f"b.{key}").alias(key), F.col("b.first_pos").alias("first_pos"))
        .distinct()
        .withColumn("similar", F.lit(True))
    )
    flagged = distinct.join(similar, [key, "first_pos"], "left")
    repeats = F.filter("positions", lambda pos: F.col("similar").isNotNull() | (pos > F.col("first_pos")))
    return flagged.select(key, F.explode(repeats).alias("pos"))


def redundant_sentences(
    df: DataFrame, key: str, text: str, threshold: float = 0.7, out: str = "scan"
) -> DataFrame:
    """Add the verdict; the repair drops the redundant sentences."""
    dropped = redundant_positions(df, key, text, threshold).groupBy(key).agg(
        F.collect_set("pos").alias("__dropped")
    )
    joined = df.join(broadcast_if_small(stage(dropped, "dropped")), key, "left")
    kept = F.filter(
        tx.sentences(F.col(text)), lambda _, at: ~F.array_contains(F.col("__dropped"), at)
    )
    clean = F.col("__dropped").isNull()
    known = F.col(text).isNotNull()
    verdict = F.struct(
        F.when(clean, F.col(text)).otherwise(tx.join_sentences(kept)).alias("sanitized"),
        F.when(known, clean).alias("is_valid"),
        F.when(known, F.when(clean, 0.0).otherwise(1.0)).alias("risk_score"),
        F.coalesce(F.size("__dropped"), F.lit(0)).alias("n_redundant"),
    )
    return joined.withColumn(out, verdict).drop("__dropped")
