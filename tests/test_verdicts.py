"""Inputs that once gave wrong verdicts."""

import time

import pytest
from pyspark.sql import functions as F

from textguard.operators import language, pii, scored
from textguard.operators.rule import scan


def verdicts(df, rule):
    return [r[rule.name] for r in scan(df, "text", rule).orderBy("id").collect()]


def test_long_hosts_and_names_are_redacted(texts):
    host = ".".join(f"x{i}" for i in range(140))
    names = " ".join(["Anna"] * 30)
    df = texts(f"a@{host}.org end", f"see {host}.com end", f"my name is {names} and", f"a@{'b.' * 4000}org")
    for got, rest in zip(verdicts(df, pii.pii_filter("pii")), (host, host, names, "b.b"), strict=True):
        assert not got["is_valid"] and rest not in got["sanitized"] and "x1" not in got["sanitized"]


def test_unknown_entities_raise():
    assert [r.entity for r in pii.rules_for(["EMAIL_ADDRESS", "PHONE_NUMBER"])] == ["EMAIL", "PHONE"]
    with pytest.raises(ValueError):
        pii.rules_for(["LOCATION"])


def test_missing_prompt_or_tone_has_no_verdict(texts):
    df = texts("the cat and the dog are in the house").withColumn("none", F.lit(None).cast("string"))
    assert verdicts(df, language.language_same(F.col("none")))[0]["is_valid"] is None
    assert verdicts(df, scored.financial_tone(F.col("none")))[0]["is_valid"] is None


def test_sentiment_risk_stays_in_range(texts):
    rows = verdicts(texts("terrible awful loss", "a table"), scored.sentiment(0.5))
    assert all(0 < r["risk_score"] <= 1 and not r["is_valid"] for r in rows)


def test_dotted_runs_take_linear_time(texts):
    run = "a." * 500_000 + "com0 @ x.com"
    began = time.time()
    got = verdicts(texts(run, run.upper(), "x@" + run), pii.pii_filter(["EMAIL", "DOMAIN"]))
    assert time.time() - began < 30
    assert [row["sanitized"][-12:] for row in got] == ["0 @ <DOMAIN>", "COM0 @ X.COM", "> @ <DOMAIN>"]


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        ("Write to a@b.org. Or not.", "Write to <EMAIL>. Or not."),
        ("a@b.org- c@d-e.f-g.org, <h@i.co.uk>", "<EMAIL>- <EMAIL>, <<EMAIL>>"),
        ("...example.com wait...net Foo.example.com x_y.org", "...<DOMAIN> wait...net <DOMAIN> x_<DOMAIN>"),
        ("www.example.com.de at a.example.com.", "<DOMAIN>.de at <DOMAIN>."),
        ("no host.comma nor a@b nor @", "no host.comma nor a@b nor @"),
    ],
)
def test_hosts_end_where_they_end(texts, text, masked):
    assert verdicts(texts(text), pii.pii_filter(["EMAIL", "DOMAIN"]))[0]["sanitized"] == masked


def test_values_are_replaced_where_they_were_found(texts):
    source = [
        "IP 10.0.0.1 and 10.0.0.12, IP again 10.0.0.1.",
        "Mail a@b.org. Then a@b.org, [REDACTED_EMAIL_1] stood here",
        "marks \U000f0000 <\U000f0002> and <EMAIL> of me@x.org",
        None,
        "",
        "[REDACTED_IP_7]",
    ]
    done = pii.anonymize(texts(*source), "text", hidden_names=["IP"], allowed_names=["10.0.0.12"])
    rows = done.withColumn("safe", F.col("scan.sanitized")).withColumn("back", pii.restore("safe"))
    rows = rows.orderBy("id").collect()
    assert rows[0].safe == (
        "[REDACTED_CUSTOM_1] [REDACTED_IP_1] and 10.0.0.12, [REDACTED_CUSTOM_1] again [REDACTED_IP_1]."
    )
    assert rows[1].safe == (
        "Mail [REDACTED_EMAIL_1]. Then [REDACTED_EMAIL_1], [REDACTED_LITERAL_1] stood here"
    )
    assert [row.back for row in rows] == source
    assert [row.scan.is_valid for row in rows] == [False, False, False, None, True, True]
