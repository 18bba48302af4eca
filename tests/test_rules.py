import pytest
import samples as s
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.samples import COMPETITORS
from textguard.operators import language as lang
from textguard.operators import pii, scored
from textguard.operators import text_rules as rules
from textguard.operators.rule import (
    Rule,
    compose,
    flag,
    require_valid,
    scan,
    split_valid,
    violation_report,
    violation_rollup,
)

PET = T.StructType([T.StructField("pet_name", T.StringType()), T.StructField("pet_age", T.IntegerType())])

VERDICTS = [
    (lang.correct_language("en", 0.75), {"Thank you": True, "Danke": False, s.CHINESE: False}),
    (rules.ends_with(["a"]), {"Llama": True, "Mistral": False}),
    (rules.ends_with("a"), {"Llama": True, "Mistral": False}),
    (rules.ends_with([]), {"Llama": False}),
    (rules.regex_match("Open.*"), {s.OPEN_MODEL: True, s.META_MODEL: False}),
    (rules.regex_match("open-source", search=True), {s.OPEN_MODEL: False, s.META_MODEL: True}),
    (rules.quotes_price("GBP"), {s.NO_PRICE: True, s.PRICE: True}),
    (rules.quotes_price("USD"), {s.NO_PRICE: True, s.PRICE: False, "for 5 USD": False}),
    (rules.quotes_price(), {s.NO_PRICE: True, s.PRICE: False}),
    (rules.reading_level(4, 8), {s.YEAST: True, s.JAY: False, "123": False}),
    (scored.nsfw(), {s.TENET: True, s.RIVER: False}),
    (scored.profanity(), {s.DUNE: True, s.INSULT: False}),
    (scored.toxicity(), {s.PRAISE: True, s.STUPID: False}),
    (rules.valid_choices(["OpenAI", "Anthropic", "Cohere"]), {"OpenAI": True, "Google": False}),
    (rules.valid_range_json(PET, "pet_age", 0, 10), {
        '{"pet_name": "Caesar", "pet_age": 5}': True,
        '{"pet_name": "Caesar", "pet_age": 15}': False,
        '{"pet_name": "Caesar", "pet_age": "old"}': False,
        '{"pet_name": "Caesar"}': False,
        "no json": False,
    }),
    (rules.valid_json(), {
        '{ "value": "a test value" }': True,
        '{ "value": "a test value", }': False,
        '{"a":1} x': False,
        "1,2": False,
        '1],[2': False,
        '1},"w":{': False,
        "[1, 2]": True,
        '"x"': True,
        "null": True,
        "": False,
        " ": False,
    }),
    (rules.valid_python(), {s.GOOD_PYTHON: True, s.BAD_PYTHON: False, "x =": False, "": True}),
    (rules.valid_url(), {"http://www.google.com": True, "www.google.com": False, "http://a b": False}),
    (rules.web_sanitization(), {s.META_MODEL: True, s.SCRIPTED: False, "1 < 2": True}),
    (scored.unusual_prompt(), {s.GRAVITY: True, s.HARSH: False}),
    (rules.regex_scan([r"Bearer [A-Za-z0-9-._~+/]+"]), {s.BEARER: False, "nothing": True}),
    (rules.regex_scan(["[a-z]+"], is_blocked=False), {"abc": True, "123": False}),
    (rules.regex_scan(["[a-z]+"], full_match=True), {"abc": False, "abc 1": True}),
    (rules.ban_substrings(COMPETITORS), {s.CHOICES_TEXT: False, s.DUNE: True}),
    (rules.ban_substrings(["forbidden", "unwanted"], match_type="word", redact=False), {
        s.FORBIDDEN: False, "unforbidden": True, "FORBIDDEN!": False,
    }),
    (rules.ban_substrings(["forbidden", "unwanted"], match_type="word", case_sensitive=True), {
        s.FORBIDDEN: False, "FORBIDDEN!": True,
    }),
    (rules.ban_substrings(["one", "two"], contains_all=True), {"one": True, "Two, one": False}),
    (rules.competitor_check(COMPETITORS), {s.FINANCE: False, s.DUNE: True, "acorns": True}),
    (rules.competitor_check(COMPETITORS, case_sensitive=False), {"acorns": False}),
    (rules.ban_competitors(COMPETITORS, threshold=0.3), {"acorns": False, "Acorns": False, "corn": True}),
    (rules.ban_competitors(COMPETITORS, threshold=0.5), {"acorns": True, "Acorns": False}),
    (rules.token_limit(100), {s.TEMPEST: False, s.DUNE: True}),
    (rules.invisible_text(), {s.TAGGED: True, s.TAGGED + "\U000e0041": False, "a​b": False}),
    (pii.pii_filter("pii"), {s.PRIVATE: False, s.PRIVATE_SHORT: False, s.DUNE: True}),
    (pii.pii_filter(["PERSON", "EMAIL"]), {s.LI_JING: False, "IP 10.0.0.1": True}),
    (scored.code(["Python"]), {s.ADD: False, s.CONVERT: False, s.FINANCE: True}),
    (scored.ban_topics(["violence"]), {s.VIOLENCE: False, s.CINEMA: False, s.DUNE: True}),
    (scored.bias(), {s.CRIME: False, s.DUNE: True}),
    (scored.prompt_injection(), {s.OVERRIDE: False, s.GRAVITY: True}),
    (scored.no_refusal(), {s.REFUSAL: False, s.GIT: True}),
    (scored.sentiment(0), {s.FAILURES: False, s.TEMPEST: False, s.PRAISE: True, "": True}),
    (scored.financial_tone("positive"), {s.GROWTH: True, s.DOUBTS: False}),
    (lang.language(["en"]), {s.CHINESE: False, s.ENGLISH: True}),
    (lang.language(["en"], match_type="sentence"), {"This is it. Das ist es.": False, s.ENGLISH: True}),
]


@pytest.mark.parametrize("rule, expected", VERDICTS, ids=lambda x: getattr(x, "name", ""))
def test_verdicts(texts, rule, expected):
    rows = scan(texts(*expected), "text", rule).orderBy("id").collect()
    assert [row[rule.name].is_valid for row in rows] == list(expected.values())
    assert all(0 <= row[rule.name].risk_score <= 1 for row in rows)


ALL_RULES = [rule for rule, _ in VERDICTS]


@pytest.mark.parametrize("rule", ALL_RULES, ids=lambda rule: rule.name)
def test_null_has_no_verdict(texts, rule):
    row = scan(texts(None), "text", rule).first()[rule.name]
    assert (row.sanitized, row.is_valid, row.risk_score) == (None, None, None)


def fixed(texts, rule, text):
    return scan(texts(text), "text", rule).first()[rule.name].sanitized


def test_repairs(texts):
    bearer = rules.regex_scan([r"Bearer [A-Za-z0-9-._~+/]+"])
    assert fixed(texts, bearer, s.BEARER) == "[REDACTED]!"
    banned = fixed(texts, rules.ban_substrings(COMPETITORS), s.CHOICES_TEXT)
    assert banned.endswith("include [REDACTED], [REDACTED], and [REDACTED].")
    assert fixed(texts, rules.ends_with(["a"]), "Mistral") == "Mistrala"
    assert fixed(texts, scored.profanity(), s.INSULT) == "He is such a ******** and a ******* idiot."
    assert fixed(texts, scored.toxicity(), s.STUPID) == "Please look carefully."
    assert fixed(texts, scored.nsfw(), s.RIVER).endswith("do something about it.")
    assert fixed(texts, rules.web_sanitization(), s.SCRIPTED) == s.META_MODEL + " "
    assert fixed(texts, rules.invisible_text(), "a​b") == "ab"
    assert fixed(texts, rules.regex_match("Open.*"), s.META_MODEL) is None
    low = fixed(texts, rules.ban_competitors(COMPETITORS, threshold=0.3), s.FINANCE)
    high = fixed(texts, rules.ban_competitors(COMPETITORS, threshold=0.5), s.FINANCE)
    assert low.count("[REDACTED]") == 6 and high.count("[REDACTED]") == 4
    assert "acorns" in high and "acorns" not in low
    short = fixed(texts, rules.token_limit(100), s.TEMPEST)
    assert s.TEMPEST.startswith(short) and len(short) < len(s.TEMPEST)
    dropped = fixed(texts, rules.competitor_check(COMPETITORS), s.FINANCE)
    assert "JP Morgan" not in dropped and "HSBC, with" in dropped


@pytest.mark.parametrize(
    "rule, text",
    [
        (rules.web_sanitization(), "<<b>script>x <scr<script></script>ipt> a onclick= javajavascript:script:"),
        (rules.web_sanitization(), " onx onclick= = < <b>i>"),
        (rules.ban_substrings(COMPETITORS), s.FINANCE),
        (pii.pii_filter("pii"), s.PRIVATE),
        (scored.profanity(), s.INSULT + " Shit! SHIT"),
        (rules.invisible_text(), "a​\U000e0041b"),
        (rules.token_limit(3), "a b c d e"),
    ],
)
def test_repaired_text_is_valid(texts, rule, text):
    once = fixed(texts, rule, text)
    row = scan(texts(once), "text", rule).first()[rule.name]
    assert row.is_valid and row.sanitized == once


def test_tag_text(texts):
    df = texts("Enter a string: é~", "")
    hidden = df.withColumn("text", F.concat(F.lit("seen"), rules.to_tag_text(F.col("text"))))
    shown = hidden.select(rules.reveal_tag_text(F.col("text"))).collect()
    assert [row[0] for row in shown] == ["Enter a string: é~", ""]
    assert hidden.first().text == "seen" + "".join(chr(0xE0000 + ord(c)) for c in "Enter a string: é~")


def test_chunks_restore_the_text(texts):
    df = texts(s.TEMPEST.rstrip(), "", "one", s.FINANCE)
    rows = df.select("text", rules.token_chunks(F.col("text"), 7).alias("chunks")).collect()
    assert all("".join(row.chunks) == row.text for row in rows)


def test_pii_values(texts):
    gazetteer = {"LOCATION": ["Maine"], "PERSON": ["Kate"]}
    masked = fixed(texts, pii.pii_filter("pii", gazetteer), s.PRIVATE)
    for entity in (
        "PERSON LOCATION CREDIT_CARD CRYPTO DATE DOMAIN EMAIL IP PASSPORT PHONE IBAN BANK_ACCOUNT SSN DRIVER_LICENSE"
    ).split():
        assert f"<{entity}>" in masked, entity
    assert masked.count("<PERSON>") == 2
    only = fixed(texts, pii.pii_filter(["PERSON", "EMAIL"]), s.LI_JING)
    assert only == "My email address is <EMAIL>, and my Name is <PERSON>"
    spi = fixed(texts, pii.pii_filter("spi"), s.PRIVATE)
    assert "test@presidio.site" in spi and "<SSN>" in spi


def test_anonymize(texts):
    text = s.PRIVATE + " Test LLC wrote to test@presidio.site and to John Doe. My name is John Doe."
    done = pii.anonymize(
        texts(text, None, "nothing"), "text", allowed_names=["John Doe"], hidden_names=["Test LLC"]
    )
    rows = done.orderBy("id").collect()
    assert "[REDACTED_CUSTOM_1]" in rows[0].scan.sanitized
    assert rows[0].scan.sanitized.count("[REDACTED_EMAIL_1]") == 2
    assert "John Doe" in rows[0].scan.sanitized and "David" not in rows[0].scan.sanitized
    assert rows[1].scan.is_valid is None and rows[2].scan.is_valid
    vault = pii.vault_table(done, "id").filter("entity_type = 'CREDIT_CARD'").first()
    assert (vault.id, vault.idx, vault.value) == (0, 1, "4095-2609-9393-4932")
    back = done.withColumn("safe", F.col("scan.sanitized")).select(pii.restore("safe"))
    assert [row[0] for row in back.collect()][::2] == [text, "nothing"]


def test_language_same(spark):
    df = spark.createDataFrame(
        [(s.CHINESE, s.ENGLISH), (s.ENGLISH, "This is that."), ("xx", "yy")], "prompt string, output string"
    )
    rows = scan(df, "output", lang.language_same(F.col("prompt"))).collect()
    assert [row.language_same.is_valid for row in rows] == [False, True, False]


def test_expected_values_per_row(spark):
    df = spark.createDataFrame([(s.PRICE, "GBP"), (s.PRICE, "USD"), (s.PRICE, None)], "text string, currency string")
    rows = scan(df, "text", rules.quotes_price(F.col("currency"))).collect()
    assert [row.quotes_price.is_valid for row in rows] == [True, False, False]


def test_compose_chains_repairs(texts):
    chain = [rules.ban_substrings(["bad"]), scored.toxicity(), pii.pii_filter("pii")]
    df = compose(texts("bad day. You idiot. Mail a@b.org now.", "fine", None), "text", chain)
    rows = [row.scan for row in df.orderBy("id").collect()]
    assert rows[0].sanitized == "[REDACTED] day. Mail <EMAIL> now."
    assert (rows[0].is_valid, rows[0].risk_score) == (False, 1.0)
    assert rows[0].failed == ["ban_substrings", "toxicity", "pii_filter"]
    assert (rows[1].sanitized, rows[1].is_valid, rows[1].failed) == ("fine", True, [])
    assert rows[2].is_valid is None and rows[2].sanitized is None


def test_split_is_a_partition(texts):
    df = scan(texts("bad", "good", None, ""), "text", rules.ban_substrings(["bad"]), out=["scan"])
    valid, quarantine = split_valid(df, "scan")
    assert sorted(row.id for row in valid.collect()) == [1, 3]
    assert sorted(row.id for row in quarantine.collect()) == [0, 2]


def test_strict_mode_fails(texts):
    rule = rules.ban_substrings(["bad"])
    good = scan(texts("good"), "text", rule, out=["scan"])
    assert require_valid(good, "scan").count() == 1
    bad = scan(texts("good", "bad"), "text", rule, out=["scan"])
    with pytest.raises(Exception, match="scan failed for"):
        require_valid(bad, "scan").collect()


def test_reports(spark):
    rows = [("a", "x", "bad"), ("a", "y", "ok"), ("b", "x", "bad"), ("b", "x", None)]
    df = spark.createDataFrame(rows, "source string, lang string, text string")
    done = scan(df, "text", rules.ban_substrings(["bad"]), out=["scan"])
    report = {(r.source, r.lang): tuple(r)[2:] for r in violation_report(done, ["source", "lang"]).collect()}
    assert report[("b", "x")] == (2, 1, 1.0, 1.0)
    rollup = {(r.source, r.lang): tuple(r)[2:] for r in violation_rollup(done, ["source", "lang"]).collect()}
    assert rollup[(None, None)] == (4, 2, round(2 / 3, 6), 1.0)
    assert rollup[("a", None)] == (2, 1, 0.5, 1.0)


def test_lexicon_table_agrees_with_inline_list(spark, texts):
    from textguard.functions.wordlists import TOXIC

    df = texts(s.STUPID, s.DUNE, None, "idiot Idiot stupid", "")
    table = spark.createDataFrame([("toxic", e.term, e.weight) for e in TOXIC], "category string, term string, weight double")
    joined = scored.lexicon_scores(df, "id", "text", table).orderBy("id").collect()
    inline = scan(df, "text", scored.toxicity(match_type="full"), out=["scan"]).orderBy("id").collect()
    assert [(r.is_valid, r.risk_score) for r in joined] == [(r.scan.is_valid, r.scan.risk_score) for r in inline]


def test_own_rules(texts):
    shout = Rule("shout", lambda text: flag(text == F.upper(text)), F.lower)
    rows = scan(texts("LOUD", "calm"), "text", shout).orderBy("id").collect()
    assert [row.shout.sanitized for row in rows] == ["loud", "calm"]
    model = scored.scorer_rule("model", lambda batch: batch.str.len() / 10)
    rows = scan(texts("a", "long text", None), "text", model).orderBy("id").collect()
    assert [row.model.is_valid for row in rows] == [True, False, None]
