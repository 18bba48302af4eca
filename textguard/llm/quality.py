"""Quality rules as weak supervision: rules vote or abstain, and EM weighs them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions.text import bind
from textguard.llm.common import count_chars, grams, words
from textguard.session import stage

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
ROUNDS = 25
GOOD_SHARE = 0.5
PSEUDO = 20.0
# Name, vote where the rule holds (-1 rejects, 1 accepts; else it abstains), assumed accuracy.
RULES = (
    ("symbols", -1, 0.95),
    ("capitals", -1, 0.95),
    ("shouting", -1, 0.95),
    ("stutter", -1, 0.95),
    ("repeats", -1, 0.95),
    ("lines", -1, 0.95),
    ("endless_words", -1, 0.95),
    ("some_symbols", -1, 0.65),
    ("some_capitals", -1, 0.65),
    ("some_repeats", -1, 0.65),
    ("word_length", 1, 0.70),
)


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur at least twice in the text.

    Windows are compared by hash. Only a text with a repeated window sorts its
    windows; the union of the repeated ones is the sum of the steps between their
    starts, a step counting for the window's width at most.
    """

    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def repeated_starts(p: Column) -> Column:
            twin = F.filter(
                p,
                lambda x, k: (x["h"] == F.get(p, k + 1)["h"])
                | ((k > 0) & (x["h"] == F.get(p, k - 1)["h"])),
            )
            return F.array_sort(F.transform(twin, lambda x: x["i"]))

        def union(starts: Column) -> Column:
            return F.aggregate(
                F.transform(
                    starts,
                    lambda s, k: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda total, x: total + x,
            )

        return bind(placed, lambda p: bind(repeated_starts(p), union))

    def count(windows: Column) -> Column:
        none = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(none, F.lit(0)).otherwise(covered(windows))

    return bind(grams(hashes, WINDOW), count)


def _stutters(hashes: Column) -> Column:
    """Words that repeat the word before them."""
    return F.size(F.filter(hashes, lambda x, i: (i > 0) & (x == F.get(hashes, i - 1))))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add one struct, ``measured``, with the counts that the rules look at.

    All of it is computed in the row, without a shuffle. NULL texts count as empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def all_counts(tokens: Column, hashes: Column, full: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            count_chars(body, "[^#*$%&|<>]+").alias("n_symbols"),
            (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
            _repeat_words(hashes).cast("long").alias("n_repeat_words"),
            _stutters(hashes).cast("long").alias("n_stutters"),
            F.size(full).cast("long").alias("n_lines"),
            count_chars(body, r"[^\p{Lu}]+").alias("n_capitals"),
            count_chars(body, "[^!]+").alias("n_exclamations"),
        )

    def hashed(tokens: Column) -> Column:
        hashes = F.transform(tokens, lambda word: F.xxhash64(word))
        return bind(hashes, lambda h: bind(lines, lambda full: all_counts(tokens, h, full)))

    counts = bind(words(body), hashed)
    return docs.withColumn("measured", counts)


def votes(m: Column) -> Column:
    """One vote per rule: -1 rejects, 1 accepts, 0 abstains."""
    n, chars = m["n_words"], m["word_chars"]
    many_symbols, many_capitals = m["n_symbols"] * 10 > n, m["n_capitals"] * 2 > chars
    many_repeats = m["n_repeat_words"] * 100 > n * REPEAT_PERCENT
    holds = {
        "symbols": many_symbols,
        "capitals": many_capitals,
        "shouting": m["n_exclamations"] * 4 > n,
        "stutter": m["n_stutters"] * 5 > n,
        "repeats": many_repeats,
        "lines": m["n_dup_lines"] * 2 > m["n_lines"],
        "endless_words": chars > n * 40,
        "some_symbols": ~many_symbols & (m["n_symbols"] * 50 > n),
        "some_capitals": ~many_capitals & (m["n_capitals"] * 5 > chars),
        "some_repeats": ~many_repeats & (m["n_repeat_words"] * 100 > n * 15),
        "word_length": (chars >= n * 2) & (chars <= n * 12),
    }
    return F.array(*[F.when(holds[name], vote).otherwise(0) for name, vote, _ in RULES])


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * REPEAT_PERCENT
    )


def estimate(
    patterns: Sequence[tuple[Sequence[int], int]], assumed: Sequence[float]
) -> list[float]:
    """The chance of being good for each pattern of votes, by expectation-maximisation.

    ``patterns`` are (votes, number of documents). Given whether a document is good,
    rules are right independently, each with an accuracy; an abstention says nothing.
    A round weighs each pattern by the accuracies, then sets each accuracy to the share
    of the rule's votes that agree. Half the weight stays with the assumed accuracy,
    since a rule that votes alone would otherwise confirm or refute itself, and the
    share of good documents is a parameter for the same reason. ROUNDS rounds, always.
    """
    accuracies = list(assumed)
    prior = math.log(GOOD_SHARE / (1 - GOOD_SHARE))

    def posterior(pattern: Sequence[int]) -> float:
        logits = [math.log(a / (1 - a)) for a in accuracies]
        odds = prior + sum(vote * logit for vote, logit in zip(pattern, logits, strict=True))
        return 1 / (1 + math.exp(-odds))

    for _ in range(ROUNDS):
        chances = [posterior(pattern) for pattern, _ in patterns]
        fresh = []
        for rule, start in enumerate(assumed):
            cast, agreed = PSEUDO, PSEUDO * start
            for chance, (pattern, count) in zip(chances, patterns, strict=True):
                if pattern[rule]:
                    cast += 2 * count
                    agreed += count * (start + (chance if pattern[rule] > 0 else 1 - chance))
            fresh.append(agreed / cast)
        accuracies = fresh
    return [posterior(pattern) for pattern, _ in patterns]


def judge(measured: DataFrame) -> DataFrame:
    """Add ``base_failed``, ``posterior`` and ``kept`` to rows that ``measure`` made.

    The rows are grouped by their votes and base rule, at most 2 to the power of the number of
    rules (2,048) patterns, twice, whatever the size of the table; EM runs over these counts
    on the driver and the chances come back as a broadcast table of as many rows.
    """
    spark = measured.sparkSession
    # Votes and base rule come from one look at the measures, and the verdicts from the table
    # joined by them, so that no filter on a verdict measures the texts again.
    seen = bind(
        F.col("measured"),
        lambda m: F.concat(F.array_join(votes(m), ","), F.when(base_failed(m), ";failed").otherwise(";passed")),
    )
    # A key that cannot be NULL: else the join would test it below the projection, that is, twice.
    marked = measured.withColumn("__votes", F.coalesce(seen, F.lit("")))
    counted = sorted(
        (row["__votes"], row["n"])
        for row in marked.groupBy("__votes").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    totals: dict[str, int] = {}
    for key, n in counted:
        votes_cast = key.split(";")[0]
        totals[votes_cast] = totals.get(votes_cast, 0) + n
    patterns = [([int(vote) for vote in key.split(",")], n) for key, n in sorted(totals.items())]
    chances = estimate(patterns, [accuracy for _, _, accuracy in RULES])
    by_votes = dict(zip(sorted(totals), chances, strict=True))
    table = "|".join(f"{key}={by_votes[key.split(';')[0]]!r}" for key, _ in counted)
    known = (
        spark.range(1)
        .select(F.explode(F.split(F.lit(table), r"\|")).alias("pair"))
        .select(
            F.substring_index("pair", "=", 1).alias("__votes"),
            F.expr("try_cast(substring_index(pair, '=', -1) as double)").alias("posterior"),
            F.contains("pair", F.lit(";failed")).alias("base_failed"),
        )
    )
    joined = marked.join(F.broadcast(known), "__votes", "left").drop("__votes")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def quality_rules(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Measure, vote, weigh and decide: the carried columns, the measures, the verdict.

    The measures are written to the shared folder once, since both the counts of
    votes and the verdicts need them; texts are in them only if carried.

    Defined cases: NULL and empty texts have no words and fail the base rule;
    repeated rows are judged alike; any other columns are untouched; an empty table
    gives an empty table. ``measured``, ``base_failed``, ``posterior`` and ``kept``
    are reserved names and replaced.
    """
    fresh = docs.drop("measured", "base_failed", "posterior", "kept")
    rows = measure(fresh, text).select(*carry, "measured")
    return judge(stage(rows, "quality"))
