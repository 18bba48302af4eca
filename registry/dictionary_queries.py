"""Dictionary tables over documents, and the SQL that must find the same terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry import sql
from textguard.operators import dictionary
from textguard.sources.tables import table, text_table

TOKEN = sql.quoted(dictionary.TOKEN)
SIZES = [2, 3, 4]

# The dictionary, of terms of at most four tokens: how turns of conversations begin, under their role, and the names of parts.
TERMS_SQL = f"""
    terms AS (
        SELECT array_to_string(t[1:n], ' ') AS term, role AS label
        FROM (SELECT role, regexp_extract_all(text, {TOKEN}) AS t, unnest({SIZES}) AS n FROM conversations)
        WHERE len(t) >= n
        UNION ALL SELECT p_name, 'part' FROM part
    ),
    dictionary AS MATERIALIZED (
        SELECT tokens, len(tokens) AS n, e.term AS term, e.label AS label FROM (
            SELECT regexp_extract_all(lower(term), {TOKEN}) AS tokens,
                min(struct_pack(label := label, term := term)) AS e
            FROM terms GROUP BY tokens
        ) WHERE len(tokens) > 0
    )"""

HITS_SQL = f"""{TERMS_SQL},
    cut AS (SELECT doc_id, text, regexp_extract_all(lower(text), {TOKEN}) AS t FROM documents),
    placed AS (
        SELECT doc_id, i, w, lead(w, 1) OVER p AS w1, lead(w, 2) OVER p AS w2, lead(w, 3) OVER p AS w3
        FROM (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS i FROM cut)
        WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    runs AS (
        SELECT doc_id, i, 1 AS n, w AS run FROM placed
        UNION ALL SELECT doc_id, i, 2, w || chr(10) || w1 FROM placed
        UNION ALL SELECT doc_id, i, 3, w || chr(10) || w1 || chr(10) || w2 FROM placed
        UNION ALL SELECT doc_id, i, 4, w || chr(10) || w1 || chr(10) || w2 || chr(10) || w3 FROM placed),
    best AS MATERIALIZED (
        SELECT doc_id, i AS place, max(n) AS n, arg_max(term, n) AS term, arg_max(label, n) AS label
        FROM runs JOIN (SELECT array_to_string(tokens, chr(10)) AS run, term, label FROM dictionary) USING (run)
        GROUP BY doc_id, i),
    following AS MATERIALIZED (
        SELECT b.doc_id, b.place, c.place AS later
        FROM best b ASOF JOIN best c ON b.doc_id = c.doc_id AND b.place + b.n <= c.place),
    walk(doc_id, place) AS (
        SELECT doc_id, min(place) FROM best GROUP BY doc_id
        UNION ALL SELECT w.doc_id, f.later FROM walk w JOIN following f USING (doc_id, place)),
    hits AS MATERIALIZED (SELECT * FROM best SEMI JOIN walk USING (doc_id, place))"""


def dictionary_terms(spark: SparkSession, folder: str) -> DataFrame:
    turns = text_table(spark, folder, "conversations", "role", "text")
    cut = turns.select("role", dictionary.tokens(F.col("text"), True).alias("t"))
    sized = cut.withColumn("n", F.explode(F.array(*[F.lit(n) for n in SIZES]))).filter("size(t) >= n")
    begun = sized.select(
        F.array_join(F.slice("t", 1, F.col("n")), " ").alias("term"), F.col("role").alias("label")
    )
    parts = table(spark, folder, "part").select(F.col("p_name").alias("term"), F.lit("part").alias("label"))
    return begun.union(parts)


def hits(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return dictionary.find_terms(docs, "doc_id", "text", dictionary_terms(spark, folder))


@query(
    "dictionary_hits",
    f"WITH RECURSIVE {HITS_SQL} SELECT doc_id, place::INTEGER AS place, term, label FROM hits",
)
def dictionary_hits(spark, folder):
    return hits(spark, folder)


@query(
    "dictionary_counts",
    f"""WITH RECURSIVE {HITS_SQL}
    SELECT label, term, count(DISTINCT doc_id) AS n_texts, count(*) AS n_hits FROM hits GROUP BY label, term""",
)
def dictionary_counts(spark, folder):
    return dictionary.term_counts(hits(spark, folder))


@query(
    "dictionary_redact",
    f"""WITH RECURSIVE {HITS_SQL},
    spans AS (
        SELECT doc_id, list(place ORDER BY place) AS heads, list(label ORDER BY place) AS labels,
            list(term ORDER BY place) AS names, flatten(list(range(place + 1, place + n))) AS inner_
        FROM hits GROUP BY doc_id),
    pieces AS (
        SELECT doc_id, text, heads, labels, names, inner_,
            regexp_extract_all(text, {sql.quoted(dictionary.PIECE)}) AS p FROM documents LEFT JOIN spans USING (doc_id))
    SELECT doc_id, CASE WHEN heads IS NULL THEN text ELSE array_to_string(list_transform(p, lambda x, i:
            CASE WHEN list_contains(heads, i - 1)
                THEN regexp_extract(x, '^\\s*') || '<' || labels[list_position(heads, i - 1)] || '>'
            WHEN list_contains(inner_, i - 1) THEN '' ELSE x END), '') || regexp_extract(text, '\\s*$') END AS sanitized,
        {sql.yes_no('heads IS NOT NULL')}, coalesce(array_to_string(names, '|'), '') AS found
    FROM pieces""",
)
def dictionary_redact(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return dictionary.redact_terms(docs, "text", dictionary_terms(spark, folder)).select(
        "doc_id",
        "known.sanitized",
        "known.is_valid",
        "known.risk_score",
        F.array_join("known.terms", "|").alias("found"),
    )
