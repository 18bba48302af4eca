"""Dictionary tables: both ways against plain Python, plans, odd terms."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textguard.operators import dictionary
from textguard.operators.rule import compose, scan, split_valid

WORDS = ["acme", "Acme", "corp", "big", "new", "york", "times", "o", "é", "中文", "x1", "&", ".", "'"]


def cut(text):
    return re.findall(r"[^\W_]+|[^\w\s]|_", text.lower())


def brute(texts, terms):
    known = {}
    for term, label in terms:
        if term and cut(term):
            entry = (label or "", term)
            known[tuple(cut(term))] = min(known.get(tuple(cut(term)), entry), entry)
    out = []
    for key, text in texts:
        tokens, at = cut(text or ""), 0
        while at < len(tokens):
            sizes = [n for n in range(min(12, len(tokens) - at), 0, -1) if tuple(tokens[at : at + n]) in known]
            if sizes:
                label, term = known[tuple(tokens[at : at + sizes[0]])]
                out.append((key, at, term, label))
            at += sizes[0] if sizes else 1
    return sorted(out)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(8)

    def line(most):
        return "".join(rng.choice(WORDS) + rng.choice([" ", "  ", "\n", "", "."]) for _ in range(rng.randrange(most)))

    texts = [(i, line(30)) for i in range(60)] + [(60, None), (61, ""), (62, " \n"), (63, "acme corp " * 4000)]
    terms = [(line(5), rng.choice("abc")) for _ in range(70)]
    terms += [("Acme Corp", "z"), ("acme  corp", "b"), (None, "n"), ("", "e"), (" ", "e"), ("big " * 9, "long")]
    return texts, terms


@pytest.mark.parametrize("small", [True, False])
def test_against_plain_python(spark, monkeypatch, case, small):
    monkeypatch.setattr(dictionary, "TRIE_TERMS", 10**6 if small else 0)
    texts, terms = case
    df = spark.createDataFrame([(*row, "x", 1) for row in texts], "id long, text string, term string, place int")
    table = spark.createDataFrame(terms, "term string, label string")
    found = dictionary.find_terms(df, "id", "text", table)
    assert sorted(tuple(row) for row in found.collect()) == brute(texts, terms)
    assert dictionary.find_terms(df, "id", "text", table.limit(0)).count() == 0
    assert dictionary.find_terms(df.limit(0), "id", "text", table).count() == 0


def test_rule_marks_whole_terms(texts, spark):
    table = spark.createDataFrame(
        [("New York", "PLACE"), ("New York Times", "PAPER"), ("acme", "FIRM")], "term string, label string"
    )
    rule = dictionary.dictionary_rule("known", table)
    df = texts("The  new\nYork  times, ACME's\n", "acmes of Yorknew", None, "", "  Acme", "a \U000fffff acme")
    rows = [row.known for row in scan(df, "text", rule).orderBy("id").collect()]
    assert [row.sanitized for row in rows] == [
        "The  <PAPER>, <FIRM>'s\n", "acmes of Yorknew", None, "", "  <FIRM>", "a  <FIRM>",
    ]
    assert [row.is_valid for row in rows] == [False, True, None, True, False, False]
    assert rows[0].terms == ["New York Times", "acme"] and rows[1].terms == []
    hidden = dictionary.dictionary_rule("known", table, case_sensitive=True, mark="[REDACTED]")
    valid, bad = split_valid(compose(df, "text", [hidden]), "scan")
    assert sorted(row.scan.sanitized for row in bad.collect() if row.text) == [
        "The  new\nYork  times, ACME's\n",
        "a  [REDACTED]",
    ][1:]


def test_many_terms_one_pass_and_no_pattern(spark, texts):
    names = spark.range(100_000).select(
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("term"), F.lit("N").alias("label")
    )
    rule = dictionary.dictionary_rule("known", names)
    scanned = scan(texts("name 77 and name 100000 and NAME 99999"), "text", rule)
    assert scanned.first().known.terms == ["name 77", "name 99999"]
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError):
        dictionary.dictionary_rule("known", spark.range(200_001).selectExpr("'t' || id AS term", "'l' AS label"))
