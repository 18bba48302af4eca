"""What the plans must and must not contain."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from registry.text_queries import CHAIN
from textguard.operators import language, pii, scored, text_rules
from textguard.operators.rule import compose, scan
from textguard.plans import key_vectors
from textguard.session import broadcast_if_small
from textguard.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


@pytest.fixture
def documents(spark):
    return table(spark, FOLDER, "documents")


ROW_LOCAL = [
    pii.pii_filter("pii"),
    scored.toxicity(),
    scored.code(["Python"]),
    language.correct_language("en"),
    text_rules.reading_level(4, 8),
    text_rules.web_sanitization(),
    text_rules.token_limit(100),
]


def test_row_local_rules_are_one_narrow_stage(documents):
    text = plan(scan(documents.select("doc_id", "text"), "text", *ROW_LOCAL))
    assert "Exchange" not in text and "EvalPython" not in text and "Join" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_composition_stays_linear(documents):
    composed = plan(compose(documents.select("doc_id", "text"), "text", CHAIN))
    assert "Exchange" not in composed and "EvalPython" not in composed
    twice = plan(compose(documents.select("doc_id", "text"), "text", [*CHAIN, *CHAIN]))
    assert len(twice) < 4 * len(composed)


def test_anonymizing_needs_no_shuffle(documents):
    text = plan(pii.anonymize(documents, "text", allowed_names=["x"], hidden_names=["y"]).select("doc_id", "scan"))
    assert "Exchange" not in text and "EvalPython" not in text


def test_only_short_tables_are_broadcast(spark):
    short = spark.range(10).join(broadcast_if_small(spark.range(5)), "id")
    assert "BroadcastHashJoin" in plan(short)
    long = broadcast_if_small(spark.range(200), rows=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" not in plan(spark.range(10).join(long, "id"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_similar_names_meet_by_term(spark):
    names = spark.createDataFrame([("a b", 1)], "clean string, n_keys long")
    counts = key_vectors.term_counts(names)
    weights = key_vectors.tfidf(counts, key_vectors.vocabulary(names, counts))
    text = plan(key_vectors.similar_names(weights))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_reach_the_scan(documents):
    text = plan(scan(documents.filter(F.col("lang") == "en").select("doc_id", "text"), "text", ROW_LOCAL[0]))
    assert "EqualTo(lang,en)" in text
