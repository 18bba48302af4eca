"""Learned scores, induced lexicons and disguised terms against plain Python and small tables."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textguard.operators import disguised, induction
from textguard.operators import naive_bayes as bayes
from textguard.operators.rule import scan
from textguard.plans import skew

TEXTS = {
    "en": ["the house and the garden", "this is the way to the river", "they have not been here"],
    "de": ["das haus und der garten", "dies ist der weg zum fluss", "sie sind nicht hier gewesen"],
    "xx": ["zyx wvu zyx", "qqq zyx"],
}


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def joins(monkeypatch, request):
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: request.param)


def test_profiles(spark, joins):
    rows = [(i, text, lang) for i, (lang, text) in enumerate((k, t) for k, v in TEXTS.items() for t in v)]
    rows += [(90, None, "en"), (91, "the garden", None), (92, "", "de")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = bayes.language_profiles(df, "text", "lang")
    asked = spark.createDataFrame(
        [(0, "THE, garden!"), (1, "der Weg"), (2, "zyx"), (3, None), (4, ""), (5, "123"), (6, "the river")],
        "id long, text string",
    )
    found = {row.id: row for row in bayes.detect_by_profile(asked, "id", "text", model).collect()}
    assert [found[i].lang for i in range(7)] == ["en", "de", "xx", None, "und", "und", "en"]
    assert found[3].margin is None and found[0].margin > 0

    def grams(text):
        plain = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        plain = " ".join(("x" + plain + "x").split())[1:-1] if plain.strip() else " "
        return [plain[i : i + 3] for i in range(len(plain) - 2)]

    counts = {lang: Counter(g for _, t, name in rows if name == lang and t for g in grams(t)) for lang in TEXTS}
    width = len({g for c in counts.values() for g in c})
    score = Counter()
    for lang, held in counts.items():
        size = sum(held.values()) + width
        score[lang] = sum(math.floor(1000 * math.log((held[g] + 1) / size)) for g in grams("the river"))
    (_, best), (_, second), *_ = score.most_common()
    assert found[6].margin == pytest.approx((best - second) / 1000 / len(grams("the river")), abs=1e-6)


def test_learned_toxicity(spark, joins):
    rows = [(i, "you are scum friend" if i % 2 else "you are my friend", i % 2) for i in range(20)]
    df = spark.createDataFrame([*rows, (90, None, 1), (91, "you", None)], "id long, text string, label int")
    asked = spark.createDataFrame([(0, "SCUM!"), (1, "my"), (2, "other"), (3, None), (4, "")], "id long, text string")
    model = bayes.train_toxicity(df, "text", "label")
    plain = {"least": 1, "strength": -(10**6), "prior": 0}
    found = {row.id: row for row in bayes.toxicity_by_words(asked, "id", "text", model, **plain).collect()}
    assert found[0].risk_score > 0.9 and found[1].risk_score == 0.5
    assert (found[2].risk_score, found[4].risk_score, found[3].risk_score) == (0.5, 0.5, None)
    one = bayes.train_toxicity(df.filter("label = 1"), "text", "label")
    assert {r.risk_score for r in bayes.toxicity_by_words(asked, "id", "text", one, prior=0).collect()} == {0.5, None}
    sure = bayes.toxicity_by_words(asked, "id", "text", model, strength=500).orderBy("id").collect()
    assert [row.is_valid for row in sure] == [False, True, True, None, True]


def test_induced_lexicon(spark, texts, joins):
    lines = ["awful dreadful noise"] * 9 + ["lovely charming tune"] * 9 + ["dreadful grim hall"] * 9
    lines += ["charming bright hall"] * 9 + ["plain chair"] * 9
    seeds = {"awful": -1, "lovely": 1}
    learned = induction.induce_lexicon(texts(*lines, None, ""), "text", seeds, least=5, strength=500)
    weights = {row.word: row.weight for row in learned.collect()}
    assert weights["awful"] == -1000 and weights["lovely"] == 1000
    assert -500 <= weights["dreadful"] < 0 < weights["charming"] <= 500
    assert weights["grim"] < 0 < weights["bright"] and "chair" not in weights and "hall" not in weights
    once = induction.induce_lexicon(texts(*lines), "text", seeds, rounds=1, least=5, strength=500)
    assert "grim" not in {row.word for row in once.collect()}
    toned = induction.tone(texts("awful noise", "lovely", "chair", None), "id", "text", learned, 0.1).orderBy("id")
    rows = toned.collect()
    assert rows[0].tone < 0 < rows[1].tone and [r.is_valid for r in rows] == [False, True, False, None]


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_disguised_terms_against_edit_distance(spark, texts, joins):
    rng = random.Random(6)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    terms = ["".join(rng.choice("abé") for _ in range(rng.randrange(3, 8))) for _ in range(40)]
    lines = [" ".join(words[i : i + 20]) for i in range(0, 300, 20)] + [None, ""]
    df, table = texts(*lines), spark.createDataFrame([(t,) for t in terms + [None]], "term string")
    got = {tuple(row) for row in disguised.find_disguised(df, "id", "text", table).collect()}
    expected = Counter()
    for i, line in enumerate(lines):
        for word in (line or "").split():
            for term in set(terms):
                if len(term) >= 4 and len(word) >= 3 and edits(word, term) <= 1:
                    expected[i, term, word, edits(word, term)] += 1
    assert got == {(*key, n) for key, n in expected.items()}


def test_phrases_with_any_gap(texts):
    far = "ignore " + "word " * 500 + "rules"
    df = texts(far + ". Fine.", "rules ignore", "Ignore. Rules", "IGNORE all rules!", None, "")
    rows = [r.gaps for r in scan(df, "text", disguised.gapped_phrases("gaps", ["ignore rules"])).orderBy("id").collect()]
    assert [row.is_valid for row in rows] == [False, True, True, False, None, True]
    assert rows[0].sanitized == "Fine."
    anywhere = disguised.gapped_phrases("gaps", ["ignore rules"], sentence=False)
    assert [r.gaps.is_valid for r in scan(df, "text", anywhere).orderBy("id").collect()][2] is False
