"""Work that is done per batch in the tasks: the same results in whatever slices and parts it is cut."""

import base64
import random

import pyarrow as pa
from pyspark.sql import functions as F

from textguard import session
from textguard.functions import batches
from textguard.operators import dictionary, gibberish, induction, model_tokens, naive_bayes, pii
from textguard.sources.json_folder import json_files


def test_slices_hold_every_list_once():
    lists = pa.array([["a"] * n if n is not None else None for n in (3, 0, None, 9, 1, 1, 2)], pa.list_(pa.string()))
    for items in (1, 4, 100):
        cut = list(batches.slices(lists, items))
        assert [row for part in cut for row in part.to_pylist()] == lists.to_pylist()
        assert all(len(part) == 1 or batches.sizes(part).sum() <= items for part in cut)
    assert list(batches.slices(lists[:0])) == []


def test_lexicon_in_parts(spark, monkeypatch):
    """Windows are summed in the tasks, and a lexicon longer than a part gives the same sums."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("good bad aa bb cc dd ee".split()) for _ in range(30))) for i in range(40)]
    rows += [(98, None), (99, "")]
    df = spark.createDataFrame(rows, "id long, text string")

    def learn():
        learned = induction.induce_lexicon(df, "text", {"good": 1, "bad": -1}, 2, 2, 1, 1)
        plan = learned._jdf.queryExecution().toString()
        toned = induction.tone(df, "id", "text", learned)
        plan += toned._jdf.queryExecution().toString()
        assert "Generate" not in plan
        return sorted(map(tuple, learned.collect())), sorted(map(tuple, toned.collect()))

    whole = learn()
    assert len(whole[0]) > 2
    monkeypatch.setattr(induction, "LEXICON_WORDS", 2)
    assert learn() == whole


def test_long_dictionaries_give_what_a_trie_gives(spark, monkeypatch):
    """By hashed terms and by the join of runs, for hits and for redacted rows, whose keys may repeat."""
    terms = [("new york", "city"), ("york", "name"), ("new", "word"), ("x - y z", "odd"), (None, "word"), ("", "word")]
    terms = spark.createDataFrame(terms, "term string, label string")
    texts = ["In New  York, york.", "x-y z x - y", "new new york new", "nothing", "", None, " york "] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    twice = df.withColumn("id", df.id % 3)

    def found():
        hits = dictionary.find_terms(df, "id", "text", terms).collect()
        redacted = dictionary.redact_terms(twice, "text", terms).collect()
        return sorted(map(repr, hits)), sorted(map(repr, redacted))

    by_trie = found()
    assert "In <word>" not in str(by_trie) and "In <city>, <name>." in str(by_trie)
    monkeypatch.setattr(dictionary, "TRIE_TERMS", 2)
    assert found() == by_trie
    monkeypatch.setattr(dictionary, "HASHED_TERMS", 2)
    assert found() == by_trie


def test_a_task_gets_a_bounded_number_of_rows(spark):
    dealt = session.spread_rows(spark.range(1000).coalesce(1), 10)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in sizes) == 1000 and max(row["count"] for row in sizes) <= 20


def test_scores_do_not_depend_on_slices(spark, monkeypatch):
    rows = [(i, "en" if i % 3 else "de", f"The house number {i}. zxqj vvk! the the") for i in range(30)]
    rows += [(90, "en", None), (91, None, "a house"), (92, "en", ""), (93, "de", "...")]
    df = spark.createDataFrame(rows, "id long, lang string, text string")

    def judged():
        model = gibberish.train_gibberish(df, "lang", "text")
        scans = [gibberish.gibberish(df, "text", "lang", model, match_type=kind) for kind in ("sentence", "full")]
        return [sorted(map(repr, scan.collect())) for scan in scans]

    whole = judged()
    monkeypatch.setattr(gibberish, "SLICE_CHARS", 50)
    assert judged() == whole


def test_tokens_do_not_depend_on_slices(spark, tmp_path, monkeypatch):
    lines = [f"{base64.b64encode(bytes([byte])).decode()} {byte}" for byte in range(256)]
    (tmp_path / "ranks").write_text("\n".join(lines))
    df = spark.createDataFrame([(i, "some words here " * i) for i in range(20)] + [(99, None)], "id long, text string")

    def chunked():
        cut = model_tokens.model_chunks(model_tokens.load_ranks(spark, str(tmp_path / "ranks")), 8)
        return sorted(map(repr, df.select("id", cut(F.col("text")).alias("chunks")).collect()))

    whole = chunked()
    monkeypatch.setattr(model_tokens, "SLICE_PIECES", 3)
    assert chunked() == whole


def test_json_files_are_read_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k":1}')
    (tmp_path / "b.json").write_text('{"k":1,')
    rows = json_files(spark, str(tmp_path)).selectExpr("data IS NOT NULL AS good", "value").collect()
    assert sorted(map(tuple, rows)) == [(False, '{"k":1,'), (True, '{"k":1}')]


def test_profiles_add_up_in_the_tasks_as_in_a_join(spark, monkeypatch):
    texts = ["the house and", "das haus und", "\U00010400 zyx", "", None, "the the", "x", "12", "émile né à"] * 3
    langs = ["en", "de", "xx", "en", "de", "en", None, "de", "fr"] * 3
    df = spark.createDataFrame(
        [(i % 20 if i % 7 else None, text, lang) for i, (text, lang) in enumerate(zip(texts, langs))],
        "id long, text string, lang string",
    )
    model = naive_bayes.language_profiles(df, "text", "lang")

    def found():
        return sorted(map(repr, naive_bayes.detect_by_profile(df, "id", "text", model).collect()))

    in_tasks = found()
    monkeypatch.setattr(naive_bayes, "PROFILE_GAINS", 0)
    assert found() == in_tasks
    assert "'fr'" in str(in_tasks)


def test_addresses_begin_at_a_word(spark):
    """Signs in front of an address stay, as a word edge in front of the pattern has it."""
    texts = ["x [OUT].a.b@c.org", "..%_a@b.org", ".@b.org", "a.b@c.org", "--a-@b.co"]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    masked = df.select(pii.redact_pii(F.col("text"), pii.rules_for(["EMAIL"]))).collect()
    assert [row[0] for row in masked] == ["x [OUT].<EMAIL>", "..%<EMAIL>", ".@b.org", "<EMAIL>", "--<EMAIL>"]
