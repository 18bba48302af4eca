"""Helpers against skew, checked on tables where one key has most of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textguard import session
from textguard.operators import reachability, relevance
from textguard.plans import skew
from textguard.sources.pairs import conversation_pairs


@pytest.fixture
def large(monkeypatch):
    """Treat every table as too long to broadcast."""
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: False)
    monkeypatch.setattr(session, "is_small", lambda df, rows=0: False)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, large, how):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key")
    )
    lookup = session.stage(rows.select("key").distinct().filter("key <> 'k1'").withColumn("v", F.length("key")), "l")
    counts = lambda: (rows.groupBy("key").agg(F.count("*").alias("n")), "n")
    joined = skew.spread_join(rows, lookup, "key", counts, ["id"], how)
    assert sorted(joined.select("id", "key", "v").collect()) == sorted(
        rows.join(lookup, "key", how).select("id", "key", "v").collect()
    )


def test_hot_key_goes_to_many_tasks(spark, large):
    rows = spark.range(20000).select("id", F.lit("hot").alias("key"))
    lookup = session.stage(spark.createDataFrame([("hot", 1)], "key string, v int"), "l")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    joined = skew.spread_join(rows, lookup, "key", lambda: (rows.groupBy("key").agg(F.count("*").alias("n")), "n"), ["id"])
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(sizes) < 20000 / 3


def test_number_rows(spark):
    keys = [f"k{random.Random(i).randint(0, 10**9)}" for i in range(1000)]
    df = spark.createDataFrame([(key,) for key in set(keys)], "key string").repartition(5)
    rows = skew.number_rows(df, "key", "at").orderBy("at").collect()
    assert [row.key for row in rows] == sorted(set(keys))
    assert [row["at"] for row in rows] == list(range(len(rows)))


@pytest.mark.parametrize("span", [1, 3, 10, 1000])
def test_next_in_group(spark, span):
    pick = random.Random(span)
    rows = {(0 if pick.random() < 0.5 else pick.randint(1, 20), pick.randint(0, 300)) for _ in range(400)}
    df = spark.createDataFrame([(g, t, f"{g}-{t}") for g, t in rows], "g long, t long, v string")
    found = skew.next_in_group(df, "g", "t", ["v"], span).select("g", "t", "next.v")
    expected = df.select("g", "t", F.lead("v").over(Window.partitionBy("g").orderBy("t")).alias("v"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_pairs(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 3, "assistant", "a1"), (1, 4, "user", "u2"),
             (1, 5, "user", "u3"), (1, 6, "assistant", "a3"), (2, 0, "assistant", "a"), (2, 1, "user", "u")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, conversation_pairs(df).collect())) == [(1, 1, "u1", "a1"), (1, 5, "u3", "a3")]


def test_relevance_is_the_same_without_broadcast(spark, monkeypatch):
    pick = random.Random(2)
    rows = [(i, " ".join(pick.choices("the of a cat dog bird".split(), k=8)), " ".join(pick.choices("the of sun moon cat".split(), k=8))) for i in range(300)]
    rows += [(300, None, "x"), (301, "", "x"), (302, "same words", "same words")]
    df = spark.createDataFrame(rows, "id long, prompt string, output string")
    small = sorted(map(str, relevance.relevance(df, ["id"]).collect()))
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: False)
    assert sorted(map(str, relevance.relevance(df, ["id"]).collect())) == small
    last = {r.id: r for r in relevance.relevance(df, ["id"]).collect()}
    assert last[302].similarity == 1.0 and last[301].similarity == 0.0 and last[300].is_valid is None


def test_off_topic_answer_is_less_relevant(spark):
    import samples as s

    question = "what are safety rules for large language models?"
    on_topic = "Safety rules for large language models are measures that keep the models safe: rules for content, and moderation."
    df = spark.createDataFrame([(0, question, on_topic), (1, question, s.GIT)], "id long, prompt string, output string")
    on, off = relevance.relevance(df, ["id"]).orderBy("id").collect()
    assert on.similarity > off.similarity and not off.is_valid


def test_reachability(spark):
    day = "2024-01-0{} 00:00:00"
    probes = spark.createDataFrame(
        [("http://a.org/", 500, 0.1, day.format(1)), ("http://a.org/", 200, 0.1, day.format(2)),
         ("http://b.org/", 200, 5.0, day.format(1)), ("http://c.org/", 404, 0.1, day.format(1))],
        "url string, status_code int, elapsed_s double, checked_at string",
    )
    df = spark.createDataFrame(
        [(0, "see http://a.org/"), (1, "http://a.org/ http://b.org/"), (2, "http://c.org/"), (3, "http://d.org/"), (4, "none"), (5, None)],
        "id long, text string",
    )
    rows = reachability.url_reachability(df, "id", "text", probes).orderBy("id").collect()
    assert [row.is_valid for row in rows] == [True, False, False, False, True, None]


class Cluster:
    """A session of a cluster, as far as the work folder goes."""

    def __init__(self, **settings):
        self.conf = settings
        self.sparkContext = self
        self.master = "yarn"


def test_work_folder_is_the_shared_one(spark, monkeypatch, tmp_path):
    assert session.work_folder(Cluster(**{"spark.checkpoint.dir": "hdfs:///work/"})) == "hdfs:///work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_folder(Cluster())
    monkeypatch.setattr(session, "work_folder", lambda spark: str(tmp_path))
    assert session.stage(spark.range(3), "x").count() == 3
    assert any(tmp_path.iterdir())


def test_long_lexicon_gives_the_same_scores(spark, monkeypatch):
    from textguard.operators import scored

    pick = random.Random(4)
    rows = [(i, " ".join(pick.choices("idiot the the the moron cat dog".split(), k=9))) for i in range(200)] + [(200, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    lexicon = spark.createDataFrame([("a", "idiot", 0.3), ("b", "idiot", 0.1), ("a", "the", 0.1)], "category string, term string, weight double")
    small = sorted(map(str, scored.lexicon_scores(df, "id", "text", lexicon).collect()))
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: False)
    monkeypatch.setattr(scored, "is_small", lambda df, rows=0: False)
    assert sorted(map(str, scored.lexicon_scores(df, "id", "text", lexicon).collect())) == small


def test_one_cluster_with_most_keys(spark, large):
    from textguard.plans import key_clusters, key_names

    keys = [f"order_total{i}" for i in range(300)] + [f"w{chr(97 + i)} x{chr(97 + j)}" for i in range(12) for j in range(12)]
    df = spark.createDataFrame([(key,) for key in keys], "key string")
    clusters = session.stage(key_clusters.cluster_keys(df), "clusters")
    names = session.stage(key_names.cluster_names(clusters), "names")
    mapping = key_names.standard_map(clusters, names).collect()
    assert len(mapping) == len(keys)
    assert sum(row.standard_key == "order_total" for row in mapping) == 300
    parts = key_names.grouped_map(key_names.standard_map(clusters, names), size=50).collect()
    assert sum(len(row["keys"]) for row in parts) == len(keys) and max(len(row["keys"]) for row in parts) < 100


def test_rows_are_dealt_out_to_tasks_of_bounded_size(spark):
    """However many rows a split has, a task of the key queries gets about so many and no more."""
    rows = spark.range(20_000).coalesce(1)
    sizes = [r["count"] for r in session.spread_rows(rows, 500).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 40 and max(sizes) <= 520 and sum(sizes) == 20_000
    few = session.spread_rows(spark.range(3).coalesce(1), 500)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.count() == 3


@pytest.mark.parametrize("parts", [200, 16])
def test_rows_are_dealt_out_without_sorting_a_split(spark, tmp_path, monkeypatch, parts):
    """A split is neither sorted before it is dealt out nor dealt out to so many tasks that its rows are held."""
    monkeypatch.setattr(session, "DEALT_PARTS", parts, raising=False)
    rows = [(None, "same")] * 9_000 + [(i, f"text {i}") for i in range(11_000)]
    spark.createDataFrame(rows, "id long, text string").coalesce(2).write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    dealt = session.spread_rows(table, 500)
    plan = dealt._jdf.queryExecution().executedPlan().toString().lower()
    assert "roundrobin" not in plan and plan.count("exchange") == (1 if parts == 200 else 2)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 40 and max(sizes) <= (520 if parts == 200 else 620) and sum(sizes) == 20_000
    assert dealt.columns == ["id", "text"] and dealt.exceptAll(table).isEmpty() and table.exceptAll(dealt).isEmpty()
