"""Density clusters of field names: (key, cluster_id), noise as -1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.functions.wordlists import KEY_STOP_WORDS
from textguard.plans.components import connected_components
from textguard.plans.key_vectors import (
    MAX_DF,
    MIN_COSINE,
    clean_key,
    clean_names,
    similar_names,
    term_counts,
    tfidf,
    vocabulary,
)
from textguard.plans.skew import number_rows, spread_join
from textguard.session import stage

NOISE = -1


def name_clusters(
    names: DataFrame, weights: DataFrame, edges: DataFrame, min_samples: int = 2
) -> DataFrame:
    """(clean, label) after Ester et al. (1996); names left out are noise.

    A name is a core if it and its neighbours stand for ``min_samples`` keys. Cores
    that are neighbours belong together; another name joins the smallest cluster
    among its neighbours. With two samples, whoever has a neighbour is a core.
    """
    with_vector = names.join(weights.select("clean").distinct(), "clean")
    if min_samples <= 2:
        components = connected_components(edges).withColumnRenamed("node", "clean")
        alone = F.when(F.col("n_keys") >= min_samples, F.col("clean"))
        return with_vector.join(components, "clean", "left").select(
            "clean", F.coalesce("label", alone).alias("label")
        )
    with_vector = with_vector.select("clean", "n_keys")
    both = edges.select(F.col("a").alias("clean"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("clean"), F.col("a").alias("other"))
    )
    around = (
        both.join(names.select(F.col("clean").alias("other"), "n_keys"), "other")
        .groupBy("clean")
        .agg(F.sum("n_keys").alias("around"))
    )
    dense = F.col("n_keys") + F.coalesce("around", F.lit(0)) >= min_samples
    judged = stage(
        with_vector.join(around, "clean", "left").select("clean", dense.alias("core")), "judged"
    )
    cores = judged.filter("core").select("clean")
    core_edges = edges.join(cores.withColumnRenamed("clean", "a"), "a", "left_semi").join(
        cores.withColumnRenamed("clean", "b"), "b", "left_semi"
    )
    components = connected_components(core_edges).withColumnRenamed("node", "clean")
    labelled = cores.join(components, "clean", "left").select(
        "clean", F.coalesce("label", "clean").alias("label")
    )
    border = (
        both.join(judged.filter(~F.col("core")).select("clean"), "clean", "left_semi")
        .join(labelled.withColumnRenamed("clean", "other"), "other")
        .groupBy("clean")
        .agg(F.min("label").alias("label"))
    )
    return labelled.union(border)


def singletons(keys: DataFrame) -> DataFrame:
    """Every key its own cluster, numbered in the order of the keys."""
    return number_rows(keys.select("key"), "key", "cluster_id")


def cluster_keys(
    keys: DataFrame,
    min_cosine: float = MIN_COSINE,
    min_samples: int = 2,
    max_df: float = MAX_DF,
    stop_words: Sequence[str] = KEY_STOP_WORDS,
) -> DataFrame:
    """(key, cluster_id): clusters numbered by their smallest key, noise -1.

    A single key is cluster 0. If no term is left to compare, each key is a
    cluster of its own.
    """
    keys = stage(keys.select("key", clean_key(F.col("key")).alias("clean")), "keys")
    if keys.limit(2).count() < 2:
        return keys.select("key", F.lit(0).cast("long").alias("cluster_id"))
    names = stage(clean_names(keys), "names")
    counts = stage(term_counts(names, stop_words), "terms")
    vocab = stage(vocabulary(names, counts, max_df), "vocabulary")
    if vocab.isEmpty():
        return singletons(keys)
    weights = stage(tfidf(counts, vocab), "weights")
    edges = stage(similar_names(weights, min_cosine), "edges")
    labels = name_clusters(names, weights, edges, min_samples)
    labelled = labels.filter(F.col("label").isNotNull()).join(names, "clean")
    labelled = stage(labelled.select("clean", "label", "first_key"), "labelled")
    smallest = labelled.groupBy("label").agg(
        F.min("first_key").alias("smallest"), F.count(F.lit(1)).alias("n")
    )
    numbered = stage(number_rows(smallest, "smallest", "cluster_id"), "numbered")
    by_name = spread_join(
        labelled, numbered.select("label", "cluster_id"), "label", lambda: (numbered, "n"), ["clean"]
    )
    by_name = stage(by_name.select("clean", "cluster_id"), "by_name")
    clustered = spread_join(keys, by_name, "clean", lambda: (names, "n_keys"), ["key"], "left")
    return clustered.select("key", F.coalesce("cluster_id", F.lit(NOISE)).alias("cluster_id"))
