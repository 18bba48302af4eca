"""Induced lexicons and disguised terms, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry import sql
from textguard.functions import wordlists as wl
from textguard.operators import disguised, induction
from textguard.operators.rule import scan
from textguard.sources.tables import table, text_table

# Signed seeds: insults against the most frequent words of the four languages.
SEEDS = {word: -1 for word in ("worthless", "pathetic", "idiot", "scum", "trash")}
SEEDS |= {word: 1 for word in ("the", "der", "la", "les")}
WINDOW, ROUNDS, LEAST, STRENGTH = 5, 2, 5, 700
THRESHOLD = 0.4


def _induction_sql() -> str:
    """One pair of tables per round, over the same windows."""
    seeds = ", ".join(f"('{word}', {1000 * sign})" for word, sign in sorted(SEEDS.items()))
    parts = [
        f"""
    cut AS (SELECT doc_id, coalesce({sql.words('text')}, []) AS t FROM documents),
    words AS (SELECT w AS word, count(*) AS n FROM (SELECT unnest(t) AS w FROM cut) GROUP BY w),
    pairs AS MATERIALIZED (
        SELECT t[i] AS word, unnest(list_concat(t[greatest(i - {WINDOW}, 1) : i - 1], t[i + 1 : i + {WINDOW}])) AS near
        FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM cut)),
    lex0(word, weight) AS (VALUES {seeds})"""
    ]
    for at in range(ROUNDS):
        parts.append(
            f"""
    near{at} AS MATERIALIZED (
        SELECT p.word, sum(greatest(weight, 0)) AS up, sum(greatest(-weight, 0)) AS down, count(*) AS n_near
        FROM pairs p JOIN lex{at} l ON l.word = p.near GROUP BY p.word),
    lex{at + 1} AS MATERIALIZED (
        SELECT word, weight FROM lex0 UNION ALL
        SELECT word, (sign(odds) * floor(least(abs(odds), 1000) / 2))::BIGINT FROM (
            SELECT word, floor(1000 * (ln((up + 1000) / (down + 1000))
                - ln((SELECT (sum(up) + 1000) / (sum(down) + 1000) FROM near{at})))) AS odds
            FROM near{at} SEMI JOIN (SELECT * FROM words WHERE n >= {LEAST}) USING (word)
            WHERE n_near >= {LEAST} AND word NOT IN (SELECT word FROM lex0))
        WHERE abs(odds) >= {STRENGTH})"""
        )
    return "WITH " + ",".join(parts)


INDUCTION_SQL = _induction_sql()


def lexicon(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return docs, induction.induce_lexicon(docs, "text", SEEDS, WINDOW, ROUNDS, LEAST, STRENGTH)


@query("lexicon_induced", f"{INDUCTION_SQL} SELECT word, weight::BIGINT AS weight FROM lex{ROUNDS}")
def lexicon_induced(spark, folder):
    return lexicon(spark, folder)[1]


@query(
    "lexicon_tone",
    f"""{INDUCTION_SQL},
    summed AS (
        SELECT doc_id, sum(weight) AS total, count(*) AS n_known
        FROM (SELECT doc_id, unnest(t) AS word FROM cut) JOIN lex{ROUNDS} USING (word) GROUP BY doc_id),
    toned AS (
        SELECT doc_id, coalesce(n_known, 0)::BIGINT AS n_known, CASE WHEN text IS NOT NULL
            THEN round(coalesce(total / (1000 * n_known), 0), 6) END::DOUBLE AS tone
        FROM documents LEFT JOIN summed USING (doc_id))
    SELECT doc_id, n_known, tone, tone >= {THRESHOLD} AS is_valid FROM toned""",
)
def lexicon_tone(spark, folder):
    docs, learned = lexicon(spark, folder)
    return induction.tone(docs, "doc_id", "text", learned, THRESHOLD)


INSULTS = ["worthless", "pathetic", "moron", "trash"]
# Beside the insults, how the names of parts begin.
TERMS_SQL = f"""
    vocabulary AS MATERIALIZED (
        SELECT w AS word, count(*) AS n FROM (SELECT doc_id, unnest({sql.words('text')}) AS w FROM documents) GROUP BY w),
    terms AS MATERIALIZED (
        SELECT unnest([{sql.listed(INSULTS)}]) AS term
        UNION SELECT DISTINCT lower(p_name[1:6]) FROM part WHERE length(p_name) >= 6)"""


def terms(spark, folder):
    listed = spark.createDataFrame([(term,) for term in INSULTS], "term string")
    parts = table(spark, folder, "part").filter(F.length("p_name") >= 6)
    return listed.union(parts.select(F.lower(F.substring("p_name", 1, 6)).alias("term")).distinct())


@query(
    "disguised_terms",
    f"""WITH {TERMS_SQL},
    near AS (
        SELECT word, term, levenshtein(word, term) AS distance FROM vocabulary, terms
        WHERE length(word) >= 3 AND length(term) >= 4 AND abs(length(word) - length(term)) <= 1
            AND levenshtein(word, term) <= 1)
    SELECT doc_id, term, word, distance::INTEGER AS distance, count(*) AS n
    FROM (SELECT doc_id, unnest({sql.words('text')}) AS word FROM documents) JOIN near USING (word)
    GROUP BY doc_id, term, word, distance""",
)
def disguised_terms(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return disguised.find_disguised(docs, "doc_id", "text", terms(spark, folder))


PHRASES = ["you are worthless", "the of and", "que la de"]


def _ordered(x: str, phrase: str) -> str:
    pattern = "(^| )" + " (.* )?".join(phrase.split()) + "( |$)"
    return f"regexp_matches(array_to_string({sql.words(x)}, ' '), {sql.quoted(pattern)})"


def _any_phrase(x: str) -> str:
    return "(" + " OR ".join(_ordered(x, phrase) for phrase in PHRASES) + ")"


@query(
    "gapped_phrases",
    f"""
    SELECT doc_id, CASE WHEN hit THEN {sql.joined("list_filter(s, lambda u: NOT " + _any_phrase("u") + ")")} ELSE text END
        AS sanitized, {sql.yes_no('hit')}
    FROM (SELECT *, len(list_filter(s, lambda u: {_any_phrase('u')})) > 0 AS hit
        FROM (SELECT doc_id, text, {sql.sentences('text')} AS s FROM documents))
    """,
)
def gapped_phrases(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    done = scan(docs, "text", disguised.gapped_phrases("phrases", PHRASES), out=["scan"])
    return done.select("doc_id", "scan.sanitized", "scan.is_valid", "scan.risk_score")
