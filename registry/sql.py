"""Pieces of SQL that the oracles share."""

from __future__ import annotations

from collections.abc import Sequence

from textguard.functions import text as tx
from textguard.functions import wordlists as wl
from textguard.functions.wordlists import Entry, PiiRule

BLANK = "[ \\t\\n\\r\\f]"
BLANKS = "' ' || chr(9) || chr(10) || chr(12) || chr(13)"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def listed(values: Sequence[str]) -> str:
    return ", ".join(quoted(value) for value in values)


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quoted(pattern)})"


def hits(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {quoted(pattern)}))"


def replaced(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(by)}, 'g')"


def bounded(pattern: str) -> str:
    return rf"\b(?:{pattern})\b"


def sentences(x: str) -> str:
    return f"regexp_extract_all(rtrim({x}, {BLANKS}), '[^.!?]+[.!?]*')"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {quoted(tx.WORD)})"


def joined(x: str) -> str:
    return f"trim(array_to_string({x}, ''), {BLANKS})"


def word_hits(x: str, terms: Sequence[str]) -> str:
    return f"len(list_filter({words(x)}, lambda w: w IN ({listed(terms)})))"


def lexicon_score(x: str, lexicon: Sequence[Entry]) -> str:
    weights = sorted({entry.weight for entry in lexicon if not entry.phrase})
    parts = [
        f"{weight}::DOUBLE * "
        + word_hits(x, [e.term for e in lexicon if not e.phrase and e.weight == weight])
        for weight in weights
    ]
    parts += [
        f"CASE WHEN {matches(f'lower({x})', e.term)} THEN {e.weight}::DOUBLE ELSE 0 END"
        for e in lexicon
        if e.phrase
    ]
    return f"round(least(1::DOUBLE, {' + '.join(parts)}), 6)"


# The personal-data patterns as RE2 has them, written out apart from the rules.
PII_PATTERNS = {
    "EMAIL": r"\b(?:[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)\b",
    "SECRET": r'(?:(?i:bearer [A-Za-z0-9._~+/-]+|token = "[0-9a-f]{40}"))',
    "URL": r'\b(?:https?://[^ \t\n\r\f<>"]+)\b',
    "DOMAIN": r"()(\b(?:(?:[A-Za-z0-9-]+\.)+(?:com|org|net|site|io))\b)",
    "IP": r"\b(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3})\b",
    "IBAN": r"\b(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})\b",
    "CRYPTO": r"\b(?:[13][A-HJ-NP-Za-km-z1-9]{25,34})\b",
    "CREDIT_CARD": r"\b(?:[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4})\b",
    "SSN": r"\b(?:[0-9]{3}-[0-9]{2}-[0-9]{4})\b",
    "PHONE": r"(?:(?:\+1 )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}|\b[0-9]{3}[- ][0-9]{3}[- ][0-9]{4}\b|\b[0-9]{10}\b)",
    "BANK_ACCOUNT": r"\b(?:[0-9]{12})\b",
    "PASSPORT": r"\b(?:[0-9]{9})\b",
    "DRIVER_LICENSE": r"\b(?:[0-9]{7}[A-Z])\b",
    "DATE": r"\b(?:(?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2})\b",
    "PERSON": r"((?i:my name is ))([A-Z][a-z]+(?: [A-Z][a-z]+)*)",
}


def pii_pattern(rule: PiiRule) -> str:
    return PII_PATTERNS[rule.entity]


def pii_masked(x: str, rules: Sequence[PiiRule]) -> str:
    for rule in rules:
        x = replaced(x, pii_pattern(rule), rf"{chr(92) + '1' if rule.lead else ''}<{rule.entity}>")
    return x


def pii_found(x: str, rules: Sequence[PiiRule]) -> str:
    return "(" + " OR ".join(matches(x, pii_pattern(rule)) for rule in rules) + ")"


def yes_no(violated: str) -> str:
    """The verdict columns of a rule that either holds or not."""
    return f"NOT ({violated}) AS is_valid, CASE WHEN {violated} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS risk_score"


def scored(risk: str, threshold: float) -> str:
    return f"({risk}) < {threshold}::DOUBLE AS is_valid, CAST({risk} AS DOUBLE) AS risk_score"


def language(x: str, function_words: dict[str, Sequence[str]] = wl.FUNCTION_WORDS) -> str:
    """STRUCT with fields confidence and lang."""
    names = sorted(function_words)
    counts = ", ".join(f"{word_hits(x, function_words[name])}" for name in names)
    han = hits(x, r"[\x{4E00}-\x{9FFF}]")
    letters = hits(x, r"\p{L}")
    share = f"({han}) / nullif({letters}, 0)"
    pick = f"list_transform([[{counts}]], lambda c: struct_pack(confidence := round(CASE WHEN list_sum(c) > 0 THEN list_max(c) / list_sum(c) ELSE 0 END, 6)::DOUBLE, lang := CASE WHEN list_sum(c) > 0 THEN [{listed(names)}][list_position(c, list_max(c))] ELSE 'und' END))[1]"
    return f"CASE WHEN {share} >= 0.3 THEN struct_pack(confidence := round({share}, 6)::DOUBLE, lang := 'zh') ELSE {pick} END"


PAIRS = """
    SELECT conv_id, turn, text AS prompt, next_text AS output
    FROM (
        SELECT *,
            lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
            lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
        FROM conversations
    )
    WHERE role = 'user' AND next_role = 'assistant'
"""
