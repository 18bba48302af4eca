"""Terms in disguise: misspelt by one letter, or as phrases with anything in between."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.operators.rule import Rule, flag
from textguard.plans.skew import spread_join
from textguard.session import broadcast_if_small, scratch, stage

SHORTEST = 4


def neighbourhood(word: Column) -> Column:
    """The word and every string that one letter less makes of it. Two words within one edit of
    each other always share one of these."""

    def cut(chars: Column) -> Column:
        def without(at: Column) -> Column:
            return F.array_join(F.filter(chars, lambda _, i: i != at), "")

        return F.array_distinct(
            F.concat(F.array(word), F.transform(F.sequence(F.lit(0), F.size(chars) - 1), without))
        )

    return tx.bind(F.split(word, ""), cut)


def near_words(words: DataFrame, terms: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, term, distance): distinct words within one insertion, deletion or replacement of a term.

    Words and terms meet at their neighbourhoods, one row per string with a letter removed, and
    each meeting is verified; no word is compared with all terms. Words and terms shorter than
    ``shortest`` are left out: one edit makes too much of them.
    """
    long_words = words.select("word").filter(F.length("word") >= shortest - 1).distinct()
    long_terms = terms.select("term").filter(F.length("term") >= shortest).distinct()
    index = long_terms.select("term", F.explode(neighbourhood(F.col("term"))).alias("form"))
    index = broadcast_if_small(stage(index, "disguised-index"))
    met = long_words.select("word", F.explode(neighbourhood(F.col("word"))).alias("form")).join(index, "form")
    distance = F.levenshtein("word", "term")
    return met.select("word", "term").distinct().withColumn("distance", distance).filter("distance <= 1")


def find_disguised(
    df: DataFrame, key: str, text: str, terms: DataFrame, shortest: int = SHORTEST
) -> DataFrame:
    """(key, term, word, distance, n): words of each text that are a term or one edit from one.

    Each distinct word of the corpus is looked up once; what it matches is joined back to
    the words of the texts, by a broadcast where short and else spread over frequent words.
    """
    words = F.coalesce(tx.words(F.col(text)), F.array().cast("array<string>"))
    spread = df.select(key, F.explode(words).alias("word"))

    def counts() -> tuple[DataFrame, str]:
        return spread.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "n"

    with scratch(df.sparkSession):
        found = near_words(spread, terms, shortest)
        grouped = found.groupBy("word").agg(F.collect_list(F.struct("term", "distance")).alias("terms"))
        grouped = stage(grouped, "disguised-words", keep=True)
    hits = spread_join(spread, grouped, "word", counts, [key])
    counted = hits.groupBy(key, "word").agg(F.first("terms").alias("terms"), F.count(F.lit(1)).alias("n"))
    return counted.select(key, F.inline("terms"), "word", "n").select(key, "term", "word", "distance", "n")


def in_order(tokens: Column, phrase: Sequence[str]) -> Column:
    """Whether the words of a phrase stand in this order, however far apart: each is looked for
    behind the place of the one before, so that a text is read once per phrase."""
    place: Column = F.lit(0)
    found: Column = F.lit(True)
    for word in phrase:
        rest = F.slice(tokens, place + 1, F.size(tokens))
        step = F.array_position(rest, word)
        found = found & (step > 0)
        place = (place + step).cast("int")
    return found


def gapped_phrases(name: str, phrases: Iterable[str], sentence: bool = True) -> Rule:
    """Texts that hold all words of a phrase in order, within a sentence or anywhere; the repair
    leaves out such sentences, or the text."""
    split = [tuple(phrase.lower().split()) for phrase in phrases]

    def held(part: Column) -> Column:
        def any_of(tokens: Column) -> Column:
            found = F.lit(False)
            for phrase in split:
                found = found | in_order(tokens, phrase)
            return found

        return F.coalesce(tx.bind(tx.words(part), any_of), F.lit(False))

    if not sentence:
        return Rule(name, lambda text: flag(held(text)))
    return Rule(
        name,
        lambda text: flag(F.exists(tx.sentences(text), held)),
        lambda text: tx.join_sentences(F.filter(tx.sentences(text), lambda part: ~held(part))),
    )
