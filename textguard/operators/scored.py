"""Scored categories: weighted words and phrases stand in for trained models.

The score of a text is the sum of the weights found in it, at most 1. A short
list becomes patterns inside the projection; a long one is a table and takes the
join in ``lexicon_scores``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.functions import text as tx
from textguard.functions import wordlists as wl
from textguard.functions.wordlists import Entry
from textguard.operators.rule import Rule, flag, itself
from textguard.plans.skew import spread_join
from textguard.session import is_small, stage

INLINE_ENTRIES = 500


def lexicon_score(text: Column, lexicon: Sequence[Entry]) -> Column:
    """Weights of all word hits and of the phrases that occur, clipped to 1."""
    if len(lexicon) > INLINE_ENTRIES:
        raise ValueError(f"over {INLINE_ENTRIES} entries: use lexicon_scores with a table")
    lowered = F.lower(text)
    by_weight: dict[float, list[str]] = defaultdict(list)
    for entry in lexicon:
        if not entry.phrase:
            by_weight[entry.weight].append(entry.term)
    total = F.lit(0.0)
    for weight, terms in sorted(by_weight.items()):
        total = total + tx.count(lowered, tx.listed_words(terms)) * weight
    for entry in lexicon:
        if entry.phrase:
            total = total + F.when(lowered.rlike(entry.term), entry.weight).otherwise(0.0)
    return tx.clip(total)


def _anything(lexicon: Sequence[Entry]) -> str:
    words = [entry.term for entry in lexicon if not entry.phrase]
    phrases = [entry.term for entry in lexicon if entry.phrase]
    return "|".join([tx.listed(words), *phrases] if words else phrases)


def by_sentence(
    name: str, score: Callable[[Column], Column], threshold: float, first: str | None = None
) -> Rule:
    """Judge each sentence: the worst one counts, and the repair drops the bad ones.

    ``first`` is a cheap pattern without which no sentence can score.
    """

    def risk(text: Column) -> Column:
        worst = F.coalesce(F.array_max(F.transform(tx.sentences(text), score)), F.lit(0.0))
        return worst if first is None else F.when(F.lower(text).rlike(first), worst).otherwise(0.0)

    def fix(text: Column) -> Column:
        kept = F.filter(tx.sentences(text), lambda s: F.round(score(s), 6) < threshold)
        return tx.join_sentences(kept)

    return Rule(name, risk, fix, limit=threshold)


def lexicon_rule(
    name: str, lexicon: Sequence[Entry], threshold: float = 0.5, match_type: str = "full"
) -> Rule:
    def score(text: Column) -> Column:
        return lexicon_score(text, lexicon)

    if match_type == "sentence":
        return by_sentence(name, score, threshold, first=_anything(lexicon))
    return Rule(name, score, limit=threshold)


def toxicity(
    threshold: float = 0.5, match_type: str = "sentence", lexicon: Sequence[Entry] = wl.TOXIC
) -> Rule:
    return lexicon_rule("toxicity", lexicon, threshold, match_type)


def nsfw(
    threshold: float = 0.8, match_type: str = "sentence", lexicon: Sequence[Entry] = wl.NSFW
) -> Rule:
    return lexicon_rule("nsfw", lexicon, threshold, match_type)


def profanity(terms: Sequence[str] = wl.PROFANITY) -> Rule:
    """Profane words are masked letter by letter."""
    pattern = "(?i)" + tx.listed_words(terms)

    def fix(text: Column) -> Column:
        for length in sorted({len(term) for term in terms}, reverse=True):
            same = [term for term in terms if len(term) == length]
            text = F.regexp_replace(text, "(?i)" + tx.listed_words(same), "*" * length)
        return text

    return Rule("profanity", lambda text: flag(text.rlike(pattern)), fix)


def ban_topics(
    topics: Sequence[str],
    threshold: float = 0.5,
    lexicons: Mapping[str, Sequence[Entry]] = wl.TOPICS,
) -> Rule:
    """The strongest of the banned topics counts."""

    def risk(text: Column) -> Column:
        return F.greatest(F.lit(0.0), *[lexicon_score(text, lexicons[topic]) for topic in topics])

    return Rule("ban_topics", risk, limit=threshold)


def bias(threshold: float = 0.5, lexicon: Sequence[Entry] = wl.BIAS) -> Rule:
    return lexicon_rule("bias", lexicon, threshold)


def prompt_injection(threshold: float = 0.5, lexicon: Sequence[Entry] = wl.INJECTION) -> Rule:
    return lexicon_rule("prompt_injection", lexicon, threshold)


def no_refusal(threshold: float = 0.5, lexicon: Sequence[Entry] = wl.REFUSAL) -> Rule:
    return lexicon_rule("no_refusal", lexicon, threshold)


def unusual_prompt(threshold: float = 0.5, lexicon: Sequence[Entry] = wl.MANIPULATION) -> Rule:
    return lexicon_rule("unusual_prompt", lexicon, threshold)


def compound(
    text: Column, positive: Sequence[str] = wl.POSITIVE, negative: Sequence[str] = wl.NEGATIVE
) -> Column:
    """Balance of positive and negative words, from -1 to 1; 0 without either."""
    lowered = F.lower(text)
    plus = tx.count(lowered, tx.listed_words(positive))
    minus = tx.count(lowered, tx.listed_words(negative))

    def balance(counts: Column) -> Column:
        return F.try_divide(counts["plus"] - counts["minus"], counts["plus"] + counts["minus"])

    both = F.struct(plus.alias("plus"), minus.alias("minus"))
    return F.coalesce(tx.bind(both, balance), F.lit(0.0))


def sentiment(
    threshold: float = 0.0,
    positive: Sequence[str] = wl.POSITIVE,
    negative: Sequence[str] = wl.NEGATIVE,
) -> Rule:
    """Valid while the balance is at least the threshold; the risk is what is missing, at most 1."""

    def risk(text: Column) -> Column:
        def below(balance: Column) -> Column:
            missing = F.least(F.lit(1.0), F.lit(threshold) - balance)
            return F.when(balance >= threshold, 0.0).otherwise(F.greatest(F.lit(1e-6), missing))

        return tx.bind(compound(text, positive, negative), below)

    return Rule("sentiment", risk, limit=0)


def financial_tone(
    expected: Column | str,
    positive: Sequence[str] = wl.POSITIVE,
    negative: Sequence[str] = wl.NEGATIVE,
) -> Rule:
    """The tone must be the expected one, which may differ from row to row; no verdict
    where none is expected."""

    def verdict(tone: Column) -> Column:
        wanted = F.lit(expected) if isinstance(expected, str) else expected
        return F.when(wanted.isNotNull(), flag(tone != wanted))

    def tone(text: Column) -> Column:
        sign = F.signum(compound(text, positive, negative))
        names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
        return F.get(names, sign.cast("int") + 1)

    return Rule(
        "financial_tone",
        verdict,
        measure=tone,
        details={"tone": itself},
    )


def code_scores(text: Column, patterns: Mapping[str, Sequence[str]] = wl.CODE_LINES) -> Column:
    """Per language the share of non-blank lines that look like its code."""

    def share(lines: Column, name: str) -> Column:
        anything = "|".join(f"(?:{pattern})" for pattern in patterns[name])
        n_code = F.size(F.filter(lines, lambda line: line.rlike(anything)))
        return F.coalesce(F.round(F.try_divide(n_code, F.size(lines)), 6), F.lit(0.0))

    def scores(lines: Column) -> Column:
        return F.array(
            *[
                F.struct(share(lines, name).alias("score"), F.lit(name).alias("language"))
                for name in sorted(patterns)
            ]
        )

    written = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t\n\r\f]"))
    return tx.bind(written, scores)


def code(
    languages: Sequence[str],
    is_blocked: bool = True,
    threshold: float = 0.5,
    patterns: Mapping[str, Sequence[str]] = wl.CODE_LINES,
) -> Rule:
    """The likeliest language must not be a blocked one, or must be an allowed one.

    On equal scores the language that comes last in the alphabet counts.
    """

    def risk(best: Column) -> Column:
        listed = best["language"].isin(list(languages))
        return F.when(listed if is_blocked else ~listed, best["score"]).otherwise(0.0)

    return Rule(
        "code",
        risk,
        limit=threshold,
        measure=lambda text: F.array_max(code_scores(text, patterns)),
        details={"language": lambda best: F.when(best["score"] >= threshold, best["language"])},
    )


def lexicon_scores(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, threshold: float = 0.5
) -> DataFrame:
    """Score words against a lexicon table ``(category, term, weight)`` of any length.

    Every text comes back once per category. A lexicon that counting shows short is
    broadcast, and only the words that hit are shuffled, as sums per text. For a
    longer one the words of each text are counted first, so that a frequent word is
    one row per text, and the rows of such a word are spread over several tasks.
    """
    words = df.select(key, F.explode(tx.words(F.col(text))).alias("term"))
    if is_small(lexicon):
        hits = words.join(F.broadcast(lexicon), "term").withColumn("uses", F.lit(1))
    else:
        counted = stage(
            words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("uses")), "words"
        )
        sizes = counted.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        hits = spread_join(counted, lexicon, "term", lambda: (sizes, "n"), [key])
    totals = hits.groupBy(key, "category").agg(
        F.sum(F.col("weight") * F.col("uses")).alias("total")
    )
    categories = lexicon.select("category").distinct()
    names = F.sort_array(F.collect_set("category"))
    listed = df.select(key, F.col(text).isNotNull().alias("known")).withColumn(
        "category", F.explode(categories.agg(names).scalar())
    )
    risk = F.when(
        F.col("known"), F.round(tx.clip(F.coalesce(F.col("total"), F.lit(0.0))), 6)
    )
    return listed.join(totals, [key, "category"], "left").select(
        key, "category", (risk < threshold).alias("is_valid"), risk.alias("risk_score")
    )


def scorer_rule(
    name: str, score: Callable[[pd.Series], pd.Series], threshold: float = 0.5
) -> Rule:
    """Plug in a model: ``score`` maps a batch of texts to risks from 0 to 1."""

    def batches(texts: pd.Series) -> pd.Series:
        return score(texts).astype("float64")

    scorer = F.pandas_udf(batches, T.DoubleType())
    return Rule(name, lambda text: tx.clip(scorer(text)), limit=threshold)
