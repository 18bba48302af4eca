"""Learned language profiles and toxicity, scored and held out, and the SQL that learns the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry import sql
from textguard.operators import naive_bayes as bayes
from textguard.sources.tables import table, text_table

FOLDS = 5
FOLD_SQL = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {FOLDS}"


def fold() -> Column:
    """A fifth of the documents by a hash of the id; learning leaves out fold 0."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % FOLDS


def _bayes_sql(features: str) -> str:
    """``gains`` (feature, label, gain) and ``labels`` (label, unseen) from (label, feature) rows."""
    return f"""
    counts AS MATERIALIZED (
        SELECT label, feature, count(*) AS n FROM ({features}) WHERE label IS NOT NULL GROUP BY label, feature),
    sums AS MATERIALIZED (
        SELECT label, sum(n)::DOUBLE + (SELECT count(DISTINCT feature) FROM counts) AS size
        FROM counts GROUP BY label),
    labels_ AS (SELECT label, floor(1000 * ln(1 / size))::BIGINT AS unseen FROM sums),
    gains AS MATERIALIZED (
        SELECT feature, label, floor(1000 * ln((n + 1) / size))::BIGINT - floor(1000 * ln(1 / size))::BIGINT AS gain, n
        FROM counts JOIN sums USING (label))"""


LANGUAGE_SQL = rf"""
    WITH cut AS (
        SELECT doc_id, lang, {FOLD_SQL} AS fold, string_split(regexp_replace(
            ' ' || regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g') || ' ', ' +', ' ', 'g'), '') AS c
        FROM documents),
    grams AS MATERIALIZED (
        SELECT doc_id, lang, fold, c[i] || c[i + 1] || c[i + 2] AS feature
        FROM (SELECT *, unnest(range(1, len(c) - 1)) AS i FROM cut)),
    {_bayes_sql("SELECT lang AS label, feature FROM grams WHERE fold <> 0")},
    gained AS (SELECT doc_id, label, sum(gain)::BIGINT AS gain FROM grams JOIN gains USING (feature) GROUP BY ALL),
    scored AS (
        SELECT d.doc_id, l.label, coalesce(gain, 0) + greatest(len(c) - 2, 0) * unseen AS score
        FROM cut d CROSS JOIN labels_ l LEFT JOIN gained g ON g.doc_id = d.doc_id AND g.label = l.label),
    ranked AS (
        SELECT doc_id, list(label ORDER BY score DESC, label) AS names, list(score ORDER BY score DESC, label) AS s
        FROM scored GROUP BY doc_id),
    found AS (
        SELECT doc_id, d.lang AS labelled, fold, CASE WHEN len(c) > 2 THEN names[1] ELSE 'und' END AS lang,
            CASE WHEN len(c) > 2 THEN round((s[1] - s[2]) / (1000 * (len(c) - 2)), 6) ELSE 0 END::DOUBLE AS margin
        FROM cut d JOIN ranked USING (doc_id))"""


def found_languages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    model = bayes.language_profiles(docs.filter(fold() != 0), "text", "lang")
    return docs, bayes.detect_by_profile(docs, "doc_id", "text", model)


@query("language_profile", f"{LANGUAGE_SQL} SELECT doc_id, lang, margin FROM found")
def language_profile(spark, folder):
    return found_languages(spark, folder)[1]


@query(
    "language_profile_eval",
    f"""{LANGUAGE_SQL}
    SELECT labelled AS lang, lang AS found_lang, fold = 0 AS held_out, count(*) AS n FROM found GROUP BY ALL""",
)
def language_profile_eval(spark, folder):
    docs, found = found_languages(spark, folder)
    known = docs.select("doc_id", "lang", (fold() == 0).alias("held_out"))
    judged = known.join(found.select("doc_id", F.col("lang").alias("found_lang")), "doc_id")
    return judged.groupBy("lang", "found_lang", "held_out").agg(F.count(F.lit(1)).alias("n"))


TOXICITY_SQL = f"""
    WITH words AS MATERIALIZED (
        SELECT doc_id, unnest(list_distinct({sql.words('text')})) AS feature FROM documents WHERE text IS NOT NULL),
    {_bayes_sql(f"SELECT toxic AS label, feature FROM words JOIN labels USING (doc_id) WHERE {FOLD_SQL} <> 0")},
    odds AS (
        SELECT feature, coalesce(max(gain) FILTER (label = 1), 0) - coalesce(max(gain) FILTER (label = 0), 0)
            + (SELECT max(unseen) FILTER (label = 1) - max(unseen) FILTER (label = 0) FROM labels_) AS odds
        FROM gains GROUP BY feature HAVING max(n) FILTER (label = 1) >= 5),
    summed AS (
        SELECT doc_id, sum(odds.odds)::BIGINT AS odds FROM words JOIN odds USING (feature) WHERE odds >= 2000
        GROUP BY doc_id),
    judged AS (
        SELECT doc_id, CASE WHEN text IS NOT NULL THEN
            round(1 / (1 + exp(-greatest(least((coalesce(odds, 0) - 2000) / 1000, 30), -30))), 6) END::DOUBLE AS risk_score
        FROM documents LEFT JOIN summed USING (doc_id))"""


def learned_toxicity(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic", (fold() == 0).alias("held_out"))
    labelled = docs.join(labels.filter("NOT held_out"), "doc_id")
    model = bayes.train_toxicity(labelled, "text", "toxic")
    return labels, bayes.toxicity_by_words(docs, "doc_id", "text", model)


@query(
    "toxicity_words",
    f"{TOXICITY_SQL} SELECT doc_id, risk_score < 0.5 AS is_valid, risk_score FROM judged",
)
def toxicity_words(spark, folder):
    """Learned from labelled documents outside fold 0, scored on all."""
    return learned_toxicity(spark, folder)[1]


@query(
    "toxicity_words_eval",
    f"""{TOXICITY_SQL}
    SELECT held_out, round(count(*) FILTER (toxic = 1 AND NOT is_valid) / nullif(count(*) FILTER (NOT is_valid), 0), 6)
            AS precision_, round(count(*) FILTER (toxic = 1 AND NOT is_valid) / nullif(count(*) FILTER (toxic = 1), 0), 6)
            AS recall, count(*) AS n
    FROM (SELECT toxic, {FOLD_SQL} = 0 AS held_out, risk_score < 0.5 AS is_valid FROM judged JOIN labels USING (doc_id))
    GROUP BY held_out""",
)
def toxicity_words_eval(spark, folder):
    labels, judged = learned_toxicity(spark, folder)
    hit = F.count_if((F.col("toxic") == 1) & ~F.col("is_valid"))
    return (
        labels.join(judged, "doc_id")
        .groupBy("held_out")
        .agg(
            F.round(F.try_divide(hit, F.count_if(~F.col("is_valid"))), 6).alias("precision_"),
            F.round(F.try_divide(hit, F.count_if(F.col("toxic") == 1)), 6).alias("recall"),
            F.count(F.lit(1)).alias("n"),
        )
    )
