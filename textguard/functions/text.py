"""Splitting, counting and matching text, written so that Java and RE2 agree.

Classes are spelled out (no ``\\w``, ``\\b`` or ``\\s``) because the JVM and RE2
give these shorthands different meanings outside ASCII.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f"
SENTENCE = r"[^.!?]+[.!?]*"
WORD = r"[\p{L}\p{N}]+"
SPACED_TOKEN = r"[ \t\n\r\f]*(?:[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\f])"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a value inside one expression, so that it is computed once per row
    even where it is used several times or for each element of an array."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str) -> Column:
    """Find the pattern anywhere; ``.`` stops at a line feed only."""
    return text.rlike(f"(?d){pattern}")


def matches_fully(text: Column, pattern: str) -> Column:
    """Match the pattern from the first to the last character."""
    return text.rlike(rf"(?d)\A(?:{pattern})\z")


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def extract(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def sentences(text: Column) -> Column:
    """Sentences with their closing marks; a blank tail is no sentence."""
    return extract(F.rtrim(text, F.lit(BLANKS)), SENTENCE)


def words(text: Column) -> Column:
    return extract(F.lower(text), WORD)


def limit_tokens(text: Column) -> Column:
    """Tokens with the blanks before them, so that joining them restores the text."""
    return extract(text, SPACED_TOKEN)


def count_limit_tokens(text: Column) -> Column:
    """Words shortened to one letter and blanks removed leave one letter per token."""
    return F.length(F.translate(F.regexp_replace(text, "[A-Za-z0-9_]+", "x"), BLANKS, ""))


def any_of(terms: Iterable[str]) -> str:
    """One alternation of literal terms, longest first so the longest term wins."""
    ordered = sorted(set(terms), key=lambda term: (-len(term), term))
    return "|".join(re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", term) for term in ordered)


def first_of(terms: Iterable[str]) -> str:
    """A look at the next letter, which spares most places of a text the search
    through the whole alternation."""
    initials = sorted({term[:1] for term in terms})
    if not initials or "" in initials:
        return ""
    return "(?=[" + "".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", i) for i in initials) + "])"


def ascii_word(pattern: str, first: str = "") -> str:
    """The pattern with ASCII word edges on both sides."""
    return f"{first}(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"


def whole_word(pattern: str, first: str = "") -> str:
    """The pattern where it fills whole Unicode words."""
    return rf"{first}(?<![\p{{L}}\p{{N}}])(?:{pattern})(?![\p{{L}}\p{{N}}])"


def listed(terms: Iterable[str]) -> str:
    """One of the terms, anywhere."""
    return f"{first_of(terms)}(?:{any_of(terms)})"


def listed_ascii_words(terms: Iterable[str]) -> str:
    return ascii_word(any_of(terms), first_of(terms))


def listed_words(terms: Iterable[str]) -> str:
    return whole_word(any_of(terms), first_of(terms))


def trim_blanks(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def join_sentences(kept: Column) -> Column:
    return trim_blanks(F.array_join(kept, ""))


def clip(score: Column) -> Column:
    return F.least(F.lit(1.0), score)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two numeric arrays of equal length; NULL if a norm is zero."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(
            F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
            F.lit(0.0),
            lambda total, x: total + x,
        )

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left) * dot(right, right)))
