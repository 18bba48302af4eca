"""Language of a text, by script and function words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.functions.wordlists import FUNCTION_WORDS
from textguard.operators.rule import Rule, flag, itself

UNKNOWN = "und"
HAN = r"[\x{4E00}-\x{9FFF}]"
HAN_SHARE = 0.3
FunctionWords = Mapping[str, Sequence[str]]


def detect_language(text: Column, function_words: FunctionWords = FUNCTION_WORDS) -> Column:
    """STRUCT<confidence, lang>: the language with most function-word hits.

    The confidence is its share of all hits. Equal hits go to the language that
    comes first in the alphabet; a text without hits is of unknown language.
    """
    lowered = F.lower(text)
    # Letters are counted only where there are Chinese ones at all.
    chinese = F.when(
        text.rlike(HAN), F.try_divide(tx.count(lowered, HAN), tx.count(lowered, r"\p{L}"))
    )
    ranked = F.array(
        *[
            F.struct(
                tx.count(lowered, tx.listed_words(terms)).alias("hits"),
                F.lit(-position).alias("rank"),
                F.lit(name).alias("lang"),
            )
            for position, (name, terms) in enumerate(sorted(function_words.items()))
        ]
    )

    def verdict(confidence: Column, lang: Column) -> Column:
        return F.struct(F.round(confidence, 6).alias("confidence"), lang.alias("lang"))

    def chosen(hits: Column) -> Column:
        total = F.aggregate(hits, F.lit(0), lambda done, one: done + one["hits"])
        best = F.array_max(hits)
        return F.when(
            total > 0, verdict(F.try_divide(best["hits"], total), best["lang"])
        ).otherwise(verdict(F.lit(0.0), F.lit(UNKNOWN)))

    by_words = tx.bind(ranked, chosen)
    return F.when(chinese >= HAN_SHARE, verdict(chinese, F.lit("zh"))).when(
        text.isNotNull(), by_words
    )


def correct_language(
    expected: str, threshold: float = 0.75, function_words: FunctionWords = FUNCTION_WORDS
) -> Rule:
    """The expected language, with at least the given confidence."""

    return Rule(
        "correct_language",
        lambda found: flag((found["lang"] != expected) | (found["confidence"] < threshold)),
        measure=lambda text: detect_language(text, function_words),
        details={"found": itself},
    )


def language(
    valid_languages: Sequence[str],
    match_type: str = "full",
    function_words: FunctionWords = FUNCTION_WORDS,
) -> Rule:
    """One of the allowed languages, for the whole text or for each sentence."""

    def foreign(text: Column) -> Column:
        return flag(~detect_language(text, function_words)["lang"].isin(list(valid_languages)))

    def risk(text: Column) -> Column:
        if match_type == "sentence":
            worst = F.array_max(F.transform(tx.sentences(text), foreign))
            return F.coalesce(worst, F.lit(0.0))
        return foreign(text)

    return Rule("language", risk)


def language_same(prompt: Column, function_words: FunctionWords = FUNCTION_WORDS) -> Rule:
    """Prompt and output in the same, known language; no verdict without a prompt."""

    def both(text: Column) -> Column:
        return F.struct(
            detect_language(prompt, function_words)["lang"].alias("prompt"),
            detect_language(text, function_words)["lang"].alias("output"),
        )

    return Rule(
        "language_same",
        lambda langs: F.when(
            langs["prompt"].isNotNull(),
            flag((langs["prompt"] != langs["output"]) | (langs["prompt"] == UNKNOWN)),
        ),
        measure=both,
        details={
            "prompt_lang": lambda langs: langs["prompt"],
            "output_lang": lambda langs: langs["output"],
        },
    )
