"""Rules that need nothing but the text: patterns, terms, JSON, URLs, length."""

from __future__ import annotations

import ast
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.functions import text as tx
from textguard.functions.wordlists import CURRENCIES
from textguard.operators.rule import Rule, flag, itself
from textguard.session import broadcast_if_small

REDACTED = "[REDACTED]"
HTTP_URL = r"https?://[^ \t\n\r\f/?#]+(?:[/?#][^ \t\n\r\f]*)?"
HIDDEN = r"[\p{Cf}\p{Co}\p{Cn}]"
TAG_PLANE = "000E"
PREFIX_TOKENS = 500


def regex_match(pattern: str, search: bool = False) -> Rule:
    """The whole text, or with ``search`` a part of it, must match."""
    test = tx.matches if search else tx.matches_fully
    return Rule("regex_match", lambda text: flag(~test(text, pattern)))


def regex_scan(
    patterns: Sequence[str], is_blocked: bool = True, full_match: bool = False, redact: bool = True
) -> Rule:
    """Blocked patterns must not occur; otherwise one of the patterns has to."""
    test = tx.matches_fully if full_match else tx.matches

    def found(text: Column) -> Column:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | test(text, pattern)
        return hit

    def fix(text: Column) -> Column:
        for pattern in patterns if is_blocked and redact else ():
            anchored = rf"(?d)\A(?:{pattern})\z" if full_match else f"(?d){pattern}"
            text = F.regexp_replace(text, anchored, REDACTED)
        return text

    return Rule("regex_scan", lambda text: flag(found(text) if is_blocked else ~found(text)), fix)


def ban_substrings(
    substrings: Sequence[str],
    match_type: str = "str",
    case_sensitive: bool = False,
    redact: bool = True,
    contains_all: bool = False,
) -> Rule:
    """No banned term may occur; with ``contains_all`` not all of them together."""
    case = "" if case_sensitive else "(?i)"

    def pattern(terms: Sequence[str]) -> str:
        return case + (tx.listed_ascii_words(terms) if match_type == "word" else tx.listed(terms))

    def violated(text: Column) -> Column:
        if not contains_all:
            return text.rlike(pattern(substrings))
        every = F.lit(True)
        for term in substrings:
            every = every & text.rlike(pattern([term]))
        return every

    def fix(text: Column) -> Column:
        return F.regexp_replace(text, pattern(substrings), REDACTED) if redact else text

    return Rule("ban_substrings", lambda text: flag(violated(text)), fix)


def competitor_check(competitors: Sequence[str], case_sensitive: bool = True) -> Rule:
    """Sentences that name a competitor are dropped; the names found are kept."""
    case = "" if case_sensitive else "(?i)"
    anyone = case + tx.listed_ascii_words(competitors)

    def found(text: Column) -> Column:
        each = [
            F.when(text.rlike(case + tx.listed_ascii_words([name])), name)
            for name in sorted(set(competitors))
        ]
        none = F.array().cast("array<string>")
        return F.when(text.rlike(anyone), F.array_compact(F.array(*each))).otherwise(none)

    def fix(text: Column) -> Column:
        return tx.join_sentences(F.filter(tx.sentences(text), lambda s: ~s.rlike(anyone)))

    return Rule(
        "competitor_check",
        lambda names: flag(F.size(names) > 0),
        fix,
        measure=found,
        details={"found": itself},
    )


def ban_competitors(
    competitors: Sequence[str], redact: bool = True, threshold: float = 0.5, folded_score: float = 0.4
) -> Rule:
    """An exact name scores 1, a name in other letter case less."""
    exact = tx.listed_ascii_words(competitors)
    folded = f"(?i){exact}"

    def risk(text: Column) -> Column:
        return F.when(text.rlike(exact), 1.0).when(text.rlike(folded), folded_score).otherwise(0.0)

    def fix(text: Column) -> Column:
        pattern = folded if folded_score >= threshold else exact
        return F.regexp_replace(text, pattern, REDACTED) if redact else text

    return Rule("ban_competitors", risk, fix, limit=threshold)


def ends_with(end: str | Sequence[str]) -> Rule:
    """The text must end with one of the given endings; the repair appends the first."""
    ends = [end] if isinstance(end, str) else list(end)

    def risk(text: Column) -> Column:
        passed = F.lit(False)
        for ending in ends:
            passed = passed | text.endswith(ending)
        return flag(~passed)

    return Rule("ends_with", risk, lambda text: F.concat(text, F.lit(ends[0] if ends else "")))


def valid_choices(choices: Sequence[str]) -> Rule:
    return Rule("valid_choices", lambda text: flag(~text.isin(list(choices))))


def valid_range(low: float | None = None, high: float | None = None) -> Rule:
    """A number within both bounds, which are themselves allowed."""

    def risk(value: Column) -> Column:
        return flag(~_within(value, low, high))

    return Rule("valid_range", risk, on_fail="noop")


def valid_range_json(
    schema: T.StructType, name: str, low: float | None = None, high: float | None = None
) -> Rule:
    """JSON text of the declared fields, with one field within the bounds."""
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}

    def risk(record: Column) -> Column:
        passed = record[corrupt].isNull() & _within(record[name], low, high)
        return flag(~F.coalesce(passed, F.lit(False)))

    return Rule(
        "valid_range_json",
        risk,
        measure=lambda text: F.from_json(text, full, options),
        details={name: lambda record: record[name]},
    )


def _within(value: Column, low: float | None, high: float | None) -> Column:
    passed = value.isNotNull()
    if low is not None:
        passed = passed & (value >= F.lit(low))
    if high is not None:
        passed = passed & (value <= F.lit(high))
    return passed


def is_json(text: Column) -> Column:
    """Strict JSON: the parser alone accepts text after the value, so the value
    must also be the only element of an array and stand alone in an object."""
    as_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    as_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(as_array, "$", "array<variant>")) == 1
    closed = F.try_variant_get(as_object, "$", "map<string,variant>").isNotNull()
    return F.coalesce(alone & closed, F.lit(False))


def valid_json() -> Rule:
    return Rule("valid_json", lambda text: flag(~is_json(text)))


def _parses(source: str | None) -> bool | None:
    if source is None:
        return None
    try:
        ast.parse(source)
    except (SyntaxError, ValueError, MemoryError, RecursionError):
        return False
    return True


def valid_python() -> Rule:
    """Python source that parses; nothing of it is run."""
    parses = F.pandas_udf(lambda sources: sources.map(_parses).astype("boolean"), T.BooleanType())
    return Rule("valid_python", lambda good: flag(~good), measure=lambda text: parses(text))


def valid_url() -> Rule:
    """Syntax only; whether a URL answers is a join with a table of probes."""
    return Rule("valid_url", lambda text: flag(~tx.matches_fully(text, HTTP_URL)))


def web_sanitization() -> Rule:
    """No markup, script address or event handler; the repair strips them."""
    tag = r"<[ \t\n\r\f]*/?[ \t\n\r\f]*[a-z!][^>]*>"
    handler = r"[ \t\n\r\f]on[a-z]+[ \t\n\r\f]*="
    bodies = r"(?is)<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>"

    def fix(text: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(text, bodies, ""), f"(?is){tag}", "")
        opened = F.regexp_replace(bare, "(?i)<[< \\t\\n\\r\\f/]*([a-z!])", "$1")
        return F.regexp_replace(opened, f"(?i)javascript:|{handler}", REDACTED)

    return Rule(
        "web_sanitization",
        lambda text: flag(text.rlike(f"(?is)(?:{tag})|javascript:|(?:{handler})")),
        fix,
    )


def price_pattern(code: str) -> str:
    """An amount with the currency's sign before it, or its code before or after."""
    amount = "[0-9][0-9,]*(?:[.][0-9]+)?"
    sign = CURRENCIES[code].replace("$", "[$]")
    return f"{sign} ?{amount}|{code} ?{amount}|{amount} ?(?:{code}|{sign})"


def quotes_price(expected: Column | str | None = None) -> Rule:
    """No price in the expected currency, which may differ from row to row; with
    no expected currency no price at all."""

    def quoted(text: Column) -> Column:
        each = [F.when(text.rlike(price_pattern(code)), code) for code in CURRENCIES]
        none = F.array().cast("array<string>")
        return F.when(text.rlike("[0-9]"), F.array_compact(F.array(*each))).otherwise(none)

    def risk(codes: Column) -> Column:
        wanted = expected if isinstance(expected, Column) else F.lit(expected).cast("string")
        return flag(F.when(wanted.isNull(), F.size(codes) > 0).otherwise(F.array_contains(codes, wanted)))

    return Rule("quotes_price", risk, measure=quoted, details={"quoted": itself})


def reading_grade(text: Column) -> Column:
    """Grade level of Kincaid et al. (1975); NULL without words."""
    n_sentences = F.greatest(F.lit(1), tx.count(text, "[^.!?][.!?]"))

    def grade(words: Column) -> Column:
        # Words without a vowel, apart from a final e, count as one syllable.
        stems = F.regexp_replace(F.lower(F.array_join(words, " ")), "e(?= |$)", "")
        n_words = F.size(words)
        n_syllables = tx.bind(
            stems, lambda s: tx.count(s, "[aeiouy]+") + n_words - tx.count(s, "[aeiouy][^ ]*")
        )
        return 0.39 * n_words / n_sentences + 11.8 * F.try_divide(n_syllables, n_words) - 15.59

    return F.round(tx.bind(tx.extract(text, "[A-Za-z]+(?:'[A-Za-z]+)?"), grade), 6)


def reading_level(low: float, high: float) -> Rule:
    def risk(grade: Column) -> Column:
        return flag(~F.coalesce(grade.between(low, high), F.lit(False)))

    return Rule("reading_level", risk, measure=reading_grade, details={"grade": itself})


def invisible_text(hidden: str = HIDDEN) -> Rule:
    """Format, private and unassigned characters are removed."""
    return Rule(
        "invisible_text",
        lambda text: flag(text.rlike(hidden)),
        lambda text: F.regexp_replace(text, hidden, ""),
    )


def to_tag_text(text: Column) -> Column:
    """Write every character as invisible ones: its UTF-16 units moved to the plane of tags."""
    units = F.hex(F.encode(text, "UTF-16BE"))
    return F.decode(F.unhex(F.regexp_replace(units, "(.{4})", f"{TAG_PLANE}$1")), "UTF-32")


def reveal_tag_text(text: Column) -> Column:
    """The message hidden in tag characters, in readable form."""
    hidden = F.array_join(tx.extract(text, r"[\x{E0001}-\x{EFFFF}]+"), "")
    points = F.hex(F.encode(hidden, "UTF-32"))
    return F.decode(F.unhex(F.regexp_replace(points, f"{TAG_PLANE}(.{{4}})", "$1")), "UTF-16BE")


def token_limit(limit: int) -> Rule:
    """At most ``limit`` tokens; the repair keeps the first ones."""

    def fix(text: Column) -> Column:
        if limit > PREFIX_TOKENS:
            return F.array_join(F.slice(tx.limit_tokens(text), 1, limit), "")
        return F.regexp_extract(text, rf"\A(?:{tx.SPACED_TOKEN}){{0,{limit}}}", 0)

    return Rule(
        "token_limit",
        lambda n_tokens: flag(n_tokens > limit),
        fix,
        measure=tx.count_limit_tokens,
        details={"n_tokens": itself},
    )


def token_chunks(text: Column, limit: int) -> Column:
    """The whole text as pieces of at most ``limit`` tokens."""

    def pieces(tokens: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens), F.lit(limit))
        cut = F.transform(starts, lambda at: F.array_join(F.slice(tokens, at, limit), ""))
        return F.when(F.size(tokens) > 0, cut).otherwise(F.array().cast("array<string>"))

    return tx.bind(tx.limit_tokens(text), pieces)




def choices_from_table(
    df: DataFrame, column: str, allowed: DataFrame, choice: str
) -> tuple[DataFrame, DataFrame]:
    """Valid and quarantined rows against a table of allowed values of any length."""
    known = broadcast_if_small(allowed.select(F.col(choice).alias(column)).distinct())
    return df.join(known, column, "left_semi"), df.join(known, column, "left_anti")
