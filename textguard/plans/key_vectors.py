"""TF-IDF vectors of field names and the pairs of similar names.

Everything here works on distinct cleaned names with the number of keys behind
them: keys that clean to the same name have the same vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.functions.wordlists import KEY_STOP_WORDS
from textguard.plans.skew import spread_join

MAX_DF = 0.8
MIN_COSINE = 0.7


def clean_key(key: Column) -> Column:
    """Lower-case words: digits and signs dropped, camel case and underscores split."""
    plain = F.regexp_replace(key, "[^a-zA-Z \t\n\r\f\x0b_]", " ")
    split = F.regexp_replace(plain, "([a-z])([A-Z])", "$1 $2")
    return F.trim(F.regexp_replace(F.lower(split), "[ \t\n\r\f\x0b_]+", " "))


def clean_names(keys: DataFrame) -> DataFrame:
    """(clean, n_keys, first_key)"""
    return keys.groupBy(clean_key(F.col("key")).alias("clean")).agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("key").alias("first_key")
    )


def key_terms(clean: Column, stop_words: Sequence[str] = KEY_STOP_WORDS) -> Column:
    """Words of two letters or more that are no stop words, and their neighbour pairs."""
    stop = F.array(*[F.lit(word) for word in stop_words])

    def with_pairs(words: Column) -> Column:
        after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        pairs = F.zip_with(words, after, lambda left, right: F.concat(left, F.lit(" "), right))
        return F.concat(words, F.array_compact(pairs))

    kept = F.filter(
        F.split(clean, " "), lambda word: (F.length(word) >= 2) & ~F.array_contains(stop, word)
    )
    return tx.bind(kept, with_pairs)


def _counted(terms: Column) -> Column:
    """(term, tf) of each different term; equal ones are neighbours once sorted."""

    def count(sorted_terms: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(sorted_terms) - 1)
        first = F.filter(
            places,
            lambda at: ~F.get(sorted_terms, at).eqNullSafe(F.get(sorted_terms, at - 1)),
        )

        def runs(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(sorted_terms)))
            return F.zip_with(
                starts,
                ends,
                lambda start, end: F.struct(
                    F.get(sorted_terms, start).alias("term"), (end - start).cast("long").alias("tf")
                ),
            )

        return F.when(F.size(sorted_terms) > 0, tx.bind(first, runs))

    return tx.bind(F.sort_array(terms), count)


def term_counts(names: DataFrame, stop_words: Sequence[str] = KEY_STOP_WORDS) -> DataFrame:
    """(clean, n_keys, term, tf). A name comes once, so its terms are counted within its
    row: a task holds no terms, however many names it has. The outer form and the
    filter behind it work them out once; ``inline`` would do so for a filter as well.
    """
    counted = _counted(key_terms(F.col("clean"), stop_words))
    return names.select("clean", "n_keys", F.inline_outer(counted)).filter(F.col("term").isNotNull())


def vocabulary(names: DataFrame, counts: DataFrame, max_df: float = MAX_DF) -> DataFrame:
    """(term, df, n): terms found in at most that share of all n keys."""
    n = names.agg(F.sum("n_keys")).scalar()
    return (
        counts.groupBy("term")
        .agg(F.sum("n_keys").alias("df"))
        .withColumn("n", n)
        .filter(F.col("df") <= F.col("n") * F.lit(max_df))
    )


def tfidf(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(clean, term, df, weight): smoothed idf, each vector of length 1."""
    weighed = spread_join(counts, vocab, "term", lambda: (vocab, "df"), ["clean"])
    raw = F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("clean")))
    return weighed.withColumn("raw", raw).select(
        "clean", "term", "df", (F.col("raw") / norm).alias("weight")
    )


def similar_names(weights: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(a, b, cosine) of distinct names with at least that cosine, a < b.

    Terms are ordered from rare to frequent. Where the rarest term that two
    vectors share is followed by too little weight, their product cannot reach
    the bound, so names meet only at terms that still have enough weight behind
    them. Frequent terms are last in that order and bring hardly any names
    together; no pair at or above the bound is missed.
    """
    rare_first = Window.partitionBy("clean").orderBy(F.desc("df"), F.desc("term"))
    behind = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(rare_first))
    vector = F.map_from_entries(
        F.collect_list(F.struct("term", "weight")).over(Window.partitionBy("clean"))
    )
    enough = min_cosine - 1e-6
    postings = (
        weights.withColumn("behind", behind)
        .withColumn("vector", vector)
        .filter(F.col("behind") >= enough)
        .select("term", "clean", "behind", "vector")
    )
    product = F.aggregate(
        F.map_entries("left.vector"),
        F.lit(0.0),
        lambda total, e: total
        + e["value"] * F.coalesce(F.try_element_at(F.col("right.vector"), e["key"]), F.lit(0.0)),
    )
    meets = (
        (F.col("left.term") == F.col("right.term"))
        & (F.col("left.clean") < F.col("right.clean"))
        & (F.col("left.behind") * F.col("right.behind") >= enough)
    )
    return (
        postings.alias("left")
        .join(postings.alias("right"), meets)
        .select(
            F.col("left.clean").alias("a"),
            F.col("right.clean").alias("b"),
            F.round(product, 9).alias("cosine"),
        )
        .filter(F.col("cosine") >= min_cosine)
        .distinct()
    )
