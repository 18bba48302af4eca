"""One vault for all texts."""

import pytest

from textguard.operators import vault
from textguard.plans import skew

SOURCE = [
    "Mail b@x.org and a@x.org, then b@x.org.",
    "a@x.org again, [REDACTED_EMAIL_1] stood here",
    "nothing",
    None,
    "",
    "IP 10.0.0.1 and [REDACTED_EMAIL_2]",
    *["hot@x.org"] * 40,
]


@pytest.mark.parametrize("short", [True, False])
def test_one_value_has_one_placeholder(texts, monkeypatch, short):
    monkeypatch.setattr(skew, "is_small", lambda df, rows=0: short)
    done = vault.anonymize_corpus(texts(*SOURCE), "id", "text", hidden_names=["IP"])
    held = {(row.entity_type, row.value): row.placeholder for row in done.vault.collect()}
    assert held["EMAIL", "a@x.org"] == "[REDACTED_EMAIL_1]" and held["EMAIL", "hot@x.org"] == "[REDACTED_EMAIL_3]"
    assert held["LITERAL", "[REDACTED_EMAIL_2]"] == "[REDACTED_LITERAL_2]"
    rows = done.texts.orderBy("id").collect()
    assert rows[0].sanitized == "Mail [REDACTED_EMAIL_2] and [REDACTED_EMAIL_1], then [REDACTED_EMAIL_2]."
    assert rows[1].sanitized == "[REDACTED_EMAIL_1] again, [REDACTED_LITERAL_1] stood here"
    assert [row.is_valid for row in rows[:6]] == [False, False, True, None, True, False]
    back = vault.restore_corpus(done.texts, done.vault, "id").orderBy("id").collect()
    assert [row.sanitized for row in back] == SOURCE
    assert {row.entity_type: row.n for row in vault.value_report(done.vault).collect()} == {
        "EMAIL": 3, "CUSTOM": 1, "IP": 1,
    }


def test_no_texts(texts):
    done = vault.anonymize_corpus(texts("x").limit(0), "id", "text")
    assert done.texts.count() == 0 and done.vault.count() == 0
