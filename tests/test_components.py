"""Connected components: rounds, odd edges, and what stays behind."""

import os
import random

import pytest
from pyspark.sql import functions as F

from textguard import session
from textguard.plans import components, skew


def chain(n):
    """0, n, n - 1, ..., 1: the smallest node is at the end of the longest way."""
    nodes = [0, *range(n, 0, -1)]
    return list(zip(nodes, nodes[1:]))


@pytest.mark.parametrize(("nodes", "most"), [(64, 8), (4096, 14)])
def test_rounds_grow_with_the_logarithm(spark, nodes, most):
    edges = spark.createDataFrame(chain(nodes), "src long, dst long")
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    stars, folder, rounds = components.contract(edges)
    assert rounds <= most
    assert {(row.src, row.dst) for row in stars.collect()} == {(i, 0) for i in range(1, nodes + 1)}
    session.drop_folder(spark, folder)


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("short", [True, False])
def test_against_union_find(spark, monkeypatch, short):
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: short)
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000, i) for i in range(1001, 1400)] + [(7, 7), (2000, 2000), (None, 5), (6, None)] + edges[:9]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {row.node: row.label for row in components.connected_components(df).collect()}
    assert found == brute(edges)
    words = spark.createDataFrame([(f"k{a}", f"k{b}") for a, b in edges if None not in (a, b)], "a string, b string")
    named = {row.node: row.label for row in components.connected_components(words).collect()}
    assert named == brute([(f"k{a}", f"k{b}") for a, b in edges if None not in (a, b)])


def test_only_the_result_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_folder", lambda spark: str(tmp_path))
    df = spark.createDataFrame(chain(40), "a long, b long")
    assert components.connected_components(df).count() == 41
    assert [name.rsplit("-", 1)[0] for name in os.listdir(tmp_path)] == ["components"]
    nothing = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(nothing).count() == 0
