"""One standard name per cluster of field names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions.wordlists import NAME_STOP_WORDS
from textguard.plans.key_clusters import NOISE
from textguard.plans.skew import spread_join
from textguard.session import stage

GROUP_SIZE = 10_000


def standard_name(key: Column) -> Column:
    """Snake case of up to four words that mean something."""
    plain = F.regexp_replace(key, "[^a-zA-Z \t\n\r\f\x0b]", " ")
    split = F.lower(F.regexp_replace(plain, "([a-z])([A-Z])", "$1 $2"))
    words = F.regexp_extract_all(split, F.lit("[a-z]+"), F.lit(0))
    telling = F.filter(words, lambda w: ~w.isin(NAME_STOP_WORDS) & (F.length(w) > 2))
    chosen = F.when(F.size(telling) > 0, F.slice(telling, 1, 4)).otherwise(F.slice(words, 1, 3))
    return F.array_join(chosen, "_")


def longest_key() -> Column:
    """The longest key of a group, the smallest of several."""
    return F.min_by("key", F.struct(-F.length("key"), F.col("key")))


def _named(clusters: DataFrame) -> DataFrame:
    """Noise keys are named one by one, other keys with their cluster. A noise key
    may be spelled like the name of a cluster; ``name_id`` keeps them apart."""
    own = F.concat(F.lit("cluster_"), F.col("cluster_id"))
    name = F.when(F.col("cluster_id") == NOISE, F.col("key")).otherwise(own)
    return clusters.withColumn("name_key", name).withColumn(
        "name_id", F.concat_ws(":", "cluster_id", "name_key")
    )


def cluster_names(clusters: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(name_id, name_key, cluster_id, n_keys, standard_key), where a given name
    replaces the derived one; of several given for one name the smallest counts."""
    names = (
        _named(clusters)
        .groupBy("name_id", "name_key", "cluster_id")
        .agg(F.count(F.lit(1)).alias("n_keys"), standard_name(longest_key()).alias("standard_key"))
    )
    if overrides is None:
        return names
    given = overrides.groupBy("name_key").agg(F.min("standard_key").alias("given"))
    return names.join(given, "name_key", "left").withColumn(
        "standard_key", F.coalesce("given", "standard_key")
    ).drop("given")


def standard_map(clusters: DataFrame, names: DataFrame) -> DataFrame:
    """(key, cluster_id, name_key, standard_key): every key exactly once, also where
    one cluster holds a large part of the keys."""
    lookup = names.select("name_id", "standard_key")
    mapped = spread_join(_named(clusters), lookup, "name_id", lambda: (names, "n_keys"), ["key"])
    return mapped.select("key", "cluster_id", "name_key", "standard_key")


def grouped_map(mapping: DataFrame, size: int = GROUP_SIZE) -> DataFrame:
    """(standard_key, part, keys): the keys behind each name, in sorted lists.

    A name with very many keys comes in several parts, so no list and no task
    grows without bound.
    """
    sizes = stage(mapping.groupBy("standard_key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / size))
    return (
        spread_join(mapping, sizes, "standard_key", lambda: (sizes, "n"), ["key"])
        .groupBy("standard_key", part.alias("part"))
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
    )


def key_report(n_files: Column, mapping: DataFrame) -> DataFrame:
    """One row of counts: files, keys, clusters and noise keys."""
    in_cluster = F.when(F.col("cluster_id") != NOISE, F.col("cluster_id"))
    return mapping.agg(
        F.count("key").alias("total_keys"),
        F.count_distinct(in_cluster).alias("total_clusters"),
        F.count_if(F.col("cluster_id") == NOISE).alias("noise_keys"),
    ).select(n_files.alias("total_files"), "total_keys", "total_clusters", "noise_keys")
