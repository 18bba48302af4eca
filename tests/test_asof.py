"""As-of joins against a plain search, and pairs and tag text on odd rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from textguard.operators import text_rules
from textguard.plans.asof import asof_join
from textguard.sources.pairs import conversation_pairs

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("span", [1_000_000, 3_600_000_000, 10**15])
def test_against_a_search(spark, span):
    rng = random.Random(2)

    def at():
        return START + timedelta(minutes=rng.randrange(600))

    left = [(i, rng.choice(["hot", "hot", "b", "none", None]), at() if i % 17 else None) for i in range(300)]
    right = [(rng.choice(["hot", "hot", "b", "c", None]), at() if i % 19 else None, i % 9, "v") for i in range(200)]
    a = spark.createDataFrame(left, "id long, url string, seen timestamp")
    b = spark.createDataFrame(right, "url string, checked timestamp, code int, extra string")
    found = {row.id: row.code for row in asof_join(a, b, "url", "seen", "checked", ["code", "extra"], span).collect()}
    assert len(found) == 300
    for key, url, seen in left:
        known = [(t, code) for u, t, code, _ in right if u == url and url and t and seen and t <= seen]
        assert found[key] == (max(known)[1] if known else None), (key, url, seen)
    assert asof_join(a.limit(0), b, "url", "seen", "checked", ["code"], span).count() == 0
    assert asof_join(a, b.limit(0), "url", "seen", "checked", ["code"], span).filter("code IS NOT NULL").count() == 0


def test_a_hot_key_is_sorted_in_many_tasks(spark):
    a = spark.range(1000).select("id", F.lit("hot").alias("url"), (F.col("id") * 3600).cast("timestamp").alias("seen"))
    b = a.select("url", F.col("seen").alias("checked"), F.col("id").cast("int").alias("code"))
    joined = asof_join(a, b, "url", "seen", "checked", ["code"])
    assert joined.filter("code <=> CAST(id AS INT)").count() == 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__key" in plan and "__span" in plan


def test_pairs_of_conversations_without_id(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"{c}{t}") for c in (None, 1) for t in range(4)]
    pairs = conversation_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(row.prompt for row in pairs.collect()) == ["10", "12", "None0", "None2"]


def test_tag_text_hides_every_character(texts):
    source = ["a中🙂é", "plain", "", None, "\n\x00"]
    hidden = texts(*source).withColumn("tag", text_rules.to_tag_text(F.col("text")))
    rows = hidden.withColumn("back", text_rules.reveal_tag_text(F.concat(F.lit("see "), "tag"))).orderBy("id").collect()
    assert [row.back for row in rows[:4]] == source[:4]
    assert all(0xE0000 <= ord(c) <= 0xEFFFF for row in rows[:3] for c in row.tag)
