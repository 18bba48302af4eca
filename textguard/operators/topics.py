"""Topics by embedding: one centroid per label, nearest centroid per vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx

MAX_TOPICS = 1_000


def topic_centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, dim, mean): averaged per dimension, with partial sums before the shuffle."""
    return (
        vectors.select(label, F.posexplode(vector).alias("dim", "x"))
        .groupBy(label, "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("mean"))
    )


def nearest_topic(
    vectors: DataFrame, centroids: DataFrame, key: str, label: str, vector: str
) -> DataFrame:
    """(key, topic, cosine): each vector against the centroids, which are a
    parameter of one row per topic; equal cosines go to the greatest label."""
    if centroids.select(label).distinct().limit(MAX_TOPICS + 1).count() > MAX_TOPICS:
        raise ValueError(f"over {MAX_TOPICS} topics")
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("dim", "mean"))), lambda part: part["mean"]
    )
    whole = centroids.groupBy(label).agg(ordered.alias("centroid"))
    topics = whole.agg(F.collect_list(F.struct(F.col(label).alias("topic"), "centroid"))).scalar()
    scored = F.transform(
        "__topics",
        lambda t: F.struct(
            F.round(tx.cosine(F.col(vector), t["centroid"]), 6).alias("cosine"),
            t["topic"].alias("topic"),
        ),
    )
    best = vectors.withColumn("__topics", topics).select(key, F.array_max(scored).alias("best"))
    return best.select(key, "best.topic", "best.cosine")


def ban_topic_vectors(
    nearest: DataFrame, key: str, topics: Sequence, threshold: float = 0.5
) -> DataFrame:
    """A vector is banned if its nearest topic is listed and near enough."""
    banned = F.col("topic").isin(list(topics)) & (F.col("cosine") >= threshold)
    return nearest.select(
        key,
        "topic",
        "cosine",
        (~banned).alias("is_valid"),
        F.when(F.col("topic").isin(list(topics)), F.greatest(F.lit(0.0), F.col("cosine")))
        .otherwise(0.0)
        .alias("risk_score"),
    )
