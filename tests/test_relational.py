"""Repeated sentences, gibberish, topics, and streams against plain Python."""

import random
import re

import pytest
import samples as s
from pyspark.sql import functions as F

from textguard.operators import gibberish, text_rules, topics
from textguard.operators.redundancy import redundant_positions, redundant_sentences
from textguard.operators.rule import scan
from textguard.operators.toxicity_model import toxicity_by_model, train_toxicity
from textguard.streaming import scan_stream


def redundant_in(text, threshold):
    sets = [set(re.findall(r"\w+", sentence.lower())) for sentence in re.findall(r"[^.!?]+[.!?]*", text.rstrip())]
    return {
        later
        for later, b in enumerate(sets)
        if b and any(a and len(a & b) / len(a | b) >= threshold for a in sets[:later])
    }


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.8, 1.0])
def test_redundant_positions_match_brute_force(spark, threshold):
    pick = random.Random(7)
    words = "a bb ccc dddd the of and sun moon star".split()
    rows = []
    for i in range(60):
        sentences = [" ".join(pick.choices(words, k=pick.randint(1, 9))) + pick.choice(".!?") for _ in range(pick.randint(0, 25))]
        rows.append((i, " ".join(sentences) + pick.choice(["", " ", " ...", " |. |."])))
    rows.append((60, "yes. " * 300 + "no. yes indeed."))
    df = spark.createDataFrame(rows, "id long, text string")
    found = {}
    for row in redundant_positions(df, "id", "text", threshold).collect():
        found.setdefault(row.id, []).append(row.pos)
    expected = {i: sorted(redundant_in(text, threshold)) for i, text in rows}
    assert {i: sorted(p) for i, p in found.items()} == {i: p for i, p in expected.items() if p}


def test_redundant_sentences(texts):
    rows = redundant_sentences(texts(s.GPT3, s.DUNE, None, ""), "id", "text").orderBy("id").collect()
    assert [row.scan.is_valid for row in rows] == [False, True, None, True]
    assert rows[0].scan.sanitized.endswith("model to date.") and "Also" not in rows[0].scan.sanitized
    assert rows[1].scan.sanitized == s.DUNE


@pytest.fixture(scope="module")
def english(spark):
    seed = spark.createDataFrame([("en", text) for text in s.ENGLISH_SEED], "lang string, text string")
    return gibberish.train_gibberish(seed, "lang", "text")


def test_gibberish(spark, english):
    rows = [(0, "en", s.AZURE), (1, "en", s.FLOPPY), (2, "en", s.GARBLED), (3, "en", None), (4, "xx", "text"), (5, "en", "")]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    done = gibberish.gibberish(df, "text", "lang", english).orderBy("id").collect()
    assert [row.scan.is_valid for row in done][3:] == [None, None, True]
    assert [row.scan.is_valid for row in done][:2] == [True, False]
    assert "Fox fox fox" not in done[1].scan.sanitized
    full = gibberish.gibberish(df, "text", "lang", english, match_type="full").orderBy("id").collect()
    assert [row.scan.is_valid for row in full][:3] == [True, False, False]


def test_bigrams_do_not_cross_texts(spark):
    df = spark.createDataFrame([("en", "ab"), ("en", "Cd, a"), ("de", "ab"), (None, "zz"), ("en", None)], "lang string, text string")
    counts = {(r.lang, r.bigram): r.n for r in gibberish.count_pairs(df, "lang", "text").collect()}
    assert counts == {("en", "ab"): 1, ("en", "cd"): 1, ("en", "d "): 1, ("en", " a"): 1, ("de", "ab"): 1}


def test_learned_toxicity(spark):
    pick = random.Random(6)
    rows = []
    for i in range(200):
        words = pick.choices("the cat sat on a mat with the dog".split(), k=8)
        rows.append((i, " ".join(words + ["awful"] * (i % 2)), float(i % 2)))
    df = spark.createDataFrame(rows + [(200, None, None), (201, "", None)], "id long, text string, toxic double")
    model = train_toxicity(df, "text", "toxic")
    done = toxicity_by_model(df, "id", "text", model).orderBy("id").collect()
    assert [row.is_valid for row in done[:200]] == [i % 2 == 0 for i in range(200)]
    assert done[200].is_valid is None and done[201].is_valid


def test_topics(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.0, 1.0], 2), (3, [0.1, 0.8], 2)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label int")
    centroids = topics.topic_centroids(df, "label", "v")
    nearest = topics.nearest_topic(df, centroids, "id", "label", "v")
    verdicts = topics.ban_topic_vectors(nearest, "id", [2], 0.5).orderBy("id").collect()
    assert [row.topic for row in verdicts] == [1, 1, 2, 2]
    assert [row.is_valid for row in verdicts] == [True, True, False, False]


def test_stream_counts_what_the_batch_counts(spark, tmp_path):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", "bad" if m % 3 == 0 else "ok") for h in range(5) for m in range(60)]
    df = spark.createDataFrame(rows, "ts string, text string").select(F.to_timestamp("ts").alias("ts"), "text")
    for part, chunk in enumerate(df.randomSplit([0.5, 0.5], 1)):
        chunk.coalesce(1).write.parquet(str(tmp_path / "in" / f"part{part}"))
    rule = text_rules.ban_substrings(["bad"])
    stream = scan_stream.read_stream(spark, str(tmp_path / "in" / "*"), "*.parquet", df.schema)
    counts = scan_stream.violation_counts(stream, "ts", "text", rule)
    found = scan_stream.run_to_files(counts, str(tmp_path / "out"), str(tmp_path / "progress"))
    scanned = scan(df, "text", rule, out=["scan"])
    batch = scanned.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w")).agg(
        F.count("*"), F.count_if(~F.col("scan.is_valid"))
    )
    closed = sorted(tuple(row) for row in batch.collect())[:-1]
    assert sorted(tuple(row) for row in found.collect()) == closed
