"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.plans.skew import spread_join
from textguard.session import drop_folder, new_path, scratch, stage


def _sizes(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _stars(rows: DataFrame) -> DataFrame:
    """(src, dst) rows with ``least``, the smallest node next to src, src included. Nodes with
    very many edges are spread over several tasks."""
    least = rows.groupBy("src").agg(F.least("src", F.min("dst")).alias("least"))
    least = stage(least, "components-least")
    return spread_join(rows, least, "src", lambda: (_sizes(rows, "src"), "n"), ["dst"])


def large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to its smallest one."""
    both = edges.union(edges.select("dst", "src"))
    return (
        _stars(both)
        .filter(F.col("dst") > F.col("src"))
        .select(F.col("dst").alias("src"), F.col("least").alias("dst"))
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    tied = _stars(edges).select(
        F.explode(F.array("src", "dst")).alias("src"), F.col("least").alias("dst")
    )
    return tied.filter(F.col("src") != F.col("dst")).distinct()


def contract(edges: DataFrame) -> tuple[DataFrame, str, int]:
    """Turn edges (src larger than dst) into one star per component, around its smallest node.

    Large stars bring distant nodes together, small stars merge the stars that meet; a chain of
    any order shrinks by a constant factor in a round, so the number of rounds grows with the
    logarithm of its length. No round has more edges than there were at first. Returns the
    edges, the folder that holds them, and the number of rounds; the tables of a round go as
    soon as the next has been written.
    """
    spark = edges.sparkSession

    def written(rows: DataFrame, name: str) -> tuple[DataFrame, str, tuple]:
        path = new_path(spark, name)
        rows.write.parquet(path)
        table = spark.read.schema(rows.schema).parquet(path)
        # Sums of remainders cannot leave 64 bits.
        mark = F.sum(F.pmod(F.xxhash64("src", "dst"), F.lit(1 << 31)))
        return table, path, tuple(table.agg(F.count(F.lit(1)), mark).first())

    now, folder, before = written(edges.distinct(), "components-edges")
    rounds = 0
    while True:
        with scratch(spark):
            wide, wide_folder, _ = written(large_star(now), "components-large")
            fresh, fresh_folder, after = written(small_star(wide), "components-edges")
        drop_folder(spark, wide_folder)
        drop_folder(spark, folder)
        now, folder, rounds = fresh, fresh_folder, rounds + 1
        if after == before:
            return now, folder, rounds
        before = after


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node of each component, for nodes with an edge.

    Edges may come in any order, repeated, or from a node to itself; those with a NULL end
    are no edges.
    """
    spark = edges.sparkSession
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")
    )
    with scratch(spark):
        links = stage(ends, "components-links")
        stars, folder, _ = contract(links.filter("src != dst"))
        labels = stars.union(stars.select("dst", "dst")).union(links.filter("src = dst"))
        found = labels.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("label"))
        found = stage(found, "components", keep=True)
    drop_folder(spark, folder)
    return found
