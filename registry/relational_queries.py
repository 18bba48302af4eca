"""Scans that join or aggregate: repeats, relevance, topics, gibberish, URLs, streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import query, sql
from registry.text_queries import documents, pairs, verdicts
from textguard.operators import gibberish as gib
from textguard.operators import reachability, relevance as rel, scored, topics
from textguard.operators.redundancy import redundant_sentences as redundant
from textguard.operators.text_rules import valid_range_json
from textguard.operators.toxicity_model import toxicity_by_model, train_toxicity
from textguard.session import new_path
from textguard.sources.tables import table, text_table
from textguard.streaming import scan_stream

# --- repeated sentences -------------------------------------------------------


@query(
    "redundant_sentences",
    f"""
    WITH sents AS (
        SELECT doc_id, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS pos
        FROM (SELECT doc_id, {sql.sentences('text')} AS s FROM documents)
    ),
    sets AS (SELECT doc_id, pos, list_distinct({sql.words('sentence')}) AS w FROM sents),
    later AS (
        SELECT DISTINCT b.doc_id, b.pos
        FROM sets a JOIN sets b ON a.doc_id = b.doc_id AND a.pos < b.pos
            AND least(len(a.w), len(b.w)) >= 0.69 * greatest(len(a.w), len(b.w))
        WHERE len(a.w) > 0 AND len(b.w) > 0 AND len(list_intersect(a.w, b.w))
            / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.7
    ),
    dropped AS (SELECT doc_id, list(pos) AS drops, count(*) AS n FROM later GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN n IS NULL THEN text
            ELSE {sql.joined(f"list_filter({sql.sentences('text')}, lambda s, i: NOT list_contains(drops, i))")} END AS sanitized,
        {sql.yes_no('n IS NOT NULL')}, coalesce(n, 0) AS n_redundant
    FROM documents d LEFT JOIN dropped x ON d.doc_id = x.doc_id
    """,
)
def redundant_sentences(spark, folder):
    done = redundant(documents(spark, folder), "doc_id", "text")
    return done.select(
        "doc_id",
        "scan.sanitized",
        "scan.is_valid",
        "scan.risk_score",
        F.col("scan.n_redundant").cast("long").alias("n_redundant"),
    )


# --- relevance ------------------------------------------------------------------


@query(
    "relevance",
    f"""
    WITH p AS ({sql.PAIRS}),
    terms AS (
        SELECT conv_id, turn, term, sum(is_p) AS tp, sum(is_o) AS t_o
        FROM (
            SELECT conv_id, turn, unnest({sql.words('prompt')}) AS term, 1 AS is_p, 0 AS is_o FROM p
            UNION ALL
            SELECT conv_id, turn, unnest({sql.words('output')}), 0, 1 FROM p
        ) GROUP BY conv_id, turn, term
    ),
    vocab AS (
        SELECT term, ln((1 + (SELECT 2 * count(*) FROM p)) / (1 + count(*) FILTER (tp > 0) + count(*) FILTER (t_o > 0))) + 1 AS idf
        FROM terms GROUP BY term
    ),
    cosines AS (
        SELECT conv_id, turn, sum(tp * t_o * idf * idf) / nullif(sqrt(sum(tp * tp * idf * idf) * sum(t_o * t_o * idf * idf)), 0) AS c
        FROM terms JOIN vocab USING (term) GROUP BY conv_id, turn
    )
    SELECT conv_id, turn, similarity, similarity >= 0.5 AS is_valid, round(1 - similarity, 6) AS risk_score
    FROM (SELECT conv_id, turn, round(coalesce(c, 0), 6) AS similarity FROM p LEFT JOIN cosines USING (conv_id, turn))
    """,
)
def relevance(spark, folder):
    return rel.relevance(pairs(spark, folder), ["conv_id", "turn"])


@query(
    "embedding_cosine",
    """
    SELECT vec_id, similarity, similarity >= 0.5 AS is_valid, round(1 - similarity, 6) AS risk_score
    FROM (
        SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
    )
    """,
)
def embedding_cosine(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    joined = vectors.join(after, "vec_id")
    return rel.vector_relevance(joined, ["vec_id"], "embedding", "next")


# --- topics -----------------------------------------------------------------------

CENTROIDS = """
    SELECT label, i - 1 AS dim, avg(x::DOUBLE) AS mean
    FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    GROUP BY label, i
"""


@query(
    "topic_centroid",
    f"SELECT label, CAST(dim AS INTEGER) AS dim, round(mean, 6) AS mean FROM ({CENTROIDS})",
)
def topic_centroid(spark, folder):
    vectors = table(spark, folder, "embeddings")
    found = topics.topic_centroids(vectors, "label", "embedding")
    return found.withColumn("mean", F.round("mean", 6))


@query(
    "ban_topic_vectors",
    f"""
    WITH whole AS (SELECT label, list(mean ORDER BY dim) AS c FROM ({CENTROIDS}) GROUP BY label),
    best AS (
        SELECT vec_id, max(struct_pack(cosine := round(list_cosine_similarity(embedding::DOUBLE[], c), 6), topic := topic)) AS b
        FROM embeddings, (SELECT label AS topic, c FROM whole) GROUP BY vec_id
    )
    SELECT vec_id, b.topic AS topic, b.cosine AS cosine, NOT (b.topic IN (1, 4, 7) AND b.cosine >= 0.5) AS is_valid,
        CASE WHEN b.topic IN (1, 4, 7) THEN greatest(0::DOUBLE, b.cosine) ELSE 0::DOUBLE END AS risk_score
    FROM best
    """,
)
def ban_topic_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    centroids = topics.topic_centroids(vectors, "label", "embedding")
    nearest = topics.nearest_topic(vectors, centroids, "vec_id", "label", "embedding")
    return topics.ban_topic_vectors(nearest, "vec_id", [1, 4, 7])


# --- gibberish ----------------------------------------------------------------------


def letters_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z]+', ' ', 'g'))"


COUNTS = f"""
    counts AS (
        SELECT lang, substr(x, i, 2) AS bigram, count(*) AS n
        FROM (
            SELECT lang, x, unnest(range(1, length(x))) AS i
            FROM (SELECT lang, {letters_sql('text')} AS x FROM documents)
        )
        GROUP BY lang, substr(x, i, 2)
    ),
    totals AS (SELECT lang, sum(n)::BIGINT AS total FROM counts GROUP BY lang)
"""


@query(
    "bigram_model",
    f"""
    WITH {COUNTS}
    SELECT lang, bigram, n, total, round(-log2((n + 1) / (total + 729)), 6) AS surprisal
    FROM counts JOIN totals USING (lang)
    """,
)
def bigram_model(spark, folder):
    return gib.bigram_model(documents(spark, folder, "lang"), "lang", "text")


def gibberish_sql(units: str) -> str:
    return f"""
    WITH {COUNTS},
    sents AS (
        SELECT doc_id, lang, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS pos
        FROM (SELECT doc_id, lang, {sql.sentences('text')} AS s FROM documents)
    ),
    units AS (
        SELECT doc_id, lang, unnest(s) AS unit, unnest(range(1, len(s) + 1)) AS pos
        FROM (SELECT doc_id, lang, {units} AS s FROM documents)
    ),
    bits AS (
        SELECT kind, doc_id, lang, pos, any_value(x) AS x, avg(-log2((coalesce(n, 0) + 1) / (total + 729))) AS b
        FROM (
            SELECT *, substr(x, unnest(range(1, length(x))), 2) AS bigram
            FROM (
                SELECT 'train' AS kind, doc_id, lang, pos, {letters_sql('sentence')} AS x FROM sents
                UNION ALL
                SELECT 'scan', doc_id, lang, pos, {letters_sql('unit')} FROM units
            )
        ) LEFT JOIN counts USING (lang, bigram) JOIN totals USING (lang)
        GROUP BY kind, doc_id, lang, pos
    ),
    stats AS (
        SELECT lang, avg(b) AS mean, stddev_pop(b) AS sd FROM bits
        WHERE kind = 'train' AND length(x) > 20 GROUP BY lang
    ),
    risks AS (
        SELECT doc_id, pos, unit, round(CASE
            WHEN coalesce(len(list_filter(w, lambda v, i: i > 1 AND v = w[i - 1])) / nullif(len(w), 0), 0) >= 0.2 THEN 1.0
            WHEN b IS NULL THEN 0.0 ELSE 1 / (1 + exp(4 - (b - mean) / sd)) END, 6) AS risk
        FROM (SELECT *, {sql.words('unit')} AS w FROM units)
            LEFT JOIN (SELECT doc_id, pos, b FROM bits WHERE kind = 'scan') USING (doc_id, pos)
            JOIN stats USING (lang)
    ),
    worst AS (
        SELECT doc_id, max(risk) AS risk,
            {sql.joined("list(unit ORDER BY pos) FILTER (risk < 0.5)")} AS kept
        FROM risks GROUP BY doc_id
    )
    SELECT doc_id, CASE WHEN coalesce(risk, 0) < 0.5 THEN text ELSE coalesce(kept, '') END AS sanitized,
        {sql.scored('coalesce(risk, 0)', 0.5)}
    FROM documents LEFT JOIN worst USING (doc_id)
    """


def scanned_gibberish(spark, folder, match_type):
    df = documents(spark, folder, "lang")
    model = gib.train_gibberish(df, "lang", "text")
    done = gib.gibberish(df, "text", "lang", model, match_type=match_type)
    return done.select("doc_id", "scan.sanitized", "scan.is_valid", "scan.risk_score")


@query("gibberish", gibberish_sql(sql.sentences("text")))
def gibberish(spark, folder):
    return scanned_gibberish(spark, folder, "sentence")


@query("gibberish_full", gibberish_sql("[text]"))
def gibberish_full(spark, folder):
    return scanned_gibberish(spark, folder, "full")


# --- URLs ----------------------------------------------------------------------------

LINKED = "concat('Source: ', url, ' and http://www.example.com/ in ', html)"


def linked_pages(spark, folder):
    df = text_table(spark, folder, "pages", "page_id", "url", "html")
    return df.selectExpr("page_id", f"{LINKED} AS x")


URLS = f"""
    uses AS (
        SELECT DISTINCT page_id, unnest(regexp_extract_all(x, 'https?://[^ \\t\\n\\r\\f<>"]+')) AS url
        FROM (SELECT page_id, {LINKED} AS x FROM pages)
    )
"""
PROBE = """
    CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 301 WHEN 'view' THEN 404 ELSE 200 END AS status_code,
    value / 100 AS elapsed_s, ts AS checked_at
"""


@query("url_extract", f"WITH {URLS} SELECT page_id, url FROM uses")
def url_extract(spark, folder):
    return reachability.extract_urls(linked_pages(spark, folder), "page_id", "x")


@query(
    "url_reachability",
    f"""
    WITH {URLS},
    probes AS (
        SELECT url, {PROBE} FROM events JOIN pages ON user_id = page_id
        UNION ALL
        SELECT 'http://www.example.com/', {PROBE} FROM events
    ),
    newest AS (
        SELECT url, max(struct_pack(checked_at := checked_at, status_code := status_code, elapsed_s := elapsed_s)) AS p
        FROM probes GROUP BY url
    ),
    judged AS (
        SELECT page_id, count(*) AS n_urls,
            count(*) FILTER (NOT coalesce(p.status_code IN (200, 201, 202, 301, 302) AND p.elapsed_s <= 1, false)) AS n_unreachable
        FROM uses LEFT JOIN newest USING (url) GROUP BY page_id
    )
    SELECT page_id, coalesce(n_urls, 0) AS n_urls, coalesce(n_unreachable, 0) AS n_unreachable,
        {sql.yes_no('coalesce(n_unreachable, 0) > 0')}
    FROM pages LEFT JOIN judged USING (page_id)
    """,
)
def url_reachability(spark, folder):
    events = table(spark, folder, "events")
    pages = table(spark, folder, "pages").select("page_id", "url")
    probes = (
        events.join(pages, F.col("user_id") == F.col("page_id"))
        .selectExpr("url", *[part.strip() for part in PROBE.split(",")])
        .union(
            events.selectExpr(
                "'http://www.example.com/' AS url", *[part.strip() for part in PROBE.split(",")]
            )
        )
    )
    return reachability.url_reachability(linked_pages(spark, folder), "page_id", "x", probes)


def probes(spark, folder):
    events = table(spark, folder, "events")
    pages = table(spark, folder, "pages").select("page_id", "url")
    columns = [part.strip() for part in PROBE.split(",")]
    own = events.join(pages, F.col("user_id") == F.col("page_id")).selectExpr("url", *columns)
    return own.union(events.selectExpr("'http://www.example.com/' AS url", *columns))


@query(
    "url_reachability_asof",
    f"""
    WITH {URLS},
    probes AS (
        SELECT url, {PROBE} FROM events JOIN pages ON user_id = page_id
        UNION ALL
        SELECT 'http://www.example.com/', {PROBE} FROM events
    ),
    latest AS (
        SELECT url, checked_at, max(struct_pack(status_code := status_code, elapsed_s := elapsed_s)) AS p
        FROM probes GROUP BY url, checked_at
    ),
    fetched AS (SELECT page_id, ts AS fetched_at FROM pages JOIN events ON event_id = 7 * page_id),
    seen AS (
        SELECT u.page_id, p FROM (SELECT * FROM uses JOIN fetched USING (page_id)) u
        ASOF LEFT JOIN latest l ON u.url = l.url AND u.fetched_at >= l.checked_at
    ),
    judged AS (
        SELECT page_id, count(*) AS n_urls,
            count(*) FILTER (NOT coalesce(p.status_code IN (200, 201, 202, 301, 302) AND p.elapsed_s <= 1, false)) AS n_unreachable
        FROM seen GROUP BY page_id
    )
    SELECT page_id, coalesce(n_urls, 0) AS n_urls, coalesce(n_unreachable, 0) AS n_unreachable,
        {sql.yes_no('coalesce(n_unreachable, 0) > 0')}
    FROM fetched LEFT JOIN judged USING (page_id)
    """,
)
def url_reachability_asof(spark, folder):
    """Each page as of the time of one of the events, which stands for its fetch."""
    times = table(spark, folder, "events").select("event_id", F.col("ts").alias("fetched_at"))
    fetched = linked_pages(spark, folder).join(times, F.col("event_id") == 7 * F.col("page_id"))
    return reachability.url_reachability_at(fetched, "page_id", "x", "fetched_at", probes(spark, folder))


# --- streams ----------------------------------------------------------------------------


@query(
    "guard_stream",
    """
    SELECT window_start, event_type, count(*) AS n_rows, count(*) FILTER (NOT ok) AS n_violations
    FROM (
        SELECT *, date_trunc('hour', ts) AS window_start, CAST(json_extract(props, '$.k') AS INTEGER) BETWEEN 0 AND 50 AS ok
        FROM events
    )
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)
    GROUP BY window_start, event_type
    """,
)
def guard_stream(spark, folder):
    rule = valid_range_json(T.StructType([T.StructField("k", T.IntegerType())]), "k", 0, 50)
    schema = table(spark, folder, "events").schema
    stream = scan_stream.read_stream(spark, folder, "events.parquet", schema)
    counts = scan_stream.violation_counts(stream, "ts", "props", rule, by=["event_type"])
    return scan_stream.run_to_files(
        counts, new_path(spark, "stream"), new_path(spark, "stream-progress")
    )


# --- learned and plug-in scorers --------------------------------------------------------------------


@query("toxicity_lr")
def toxicity_lr(spark, folder):
    """Learned from the labels, scored on all documents; no SQL counterpart."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("double"))
    texts = documents(spark, folder)
    model = train_toxicity(texts.join(labels, "doc_id"), "text", "toxic")
    return toxicity_by_model(texts, "doc_id", "text", model)


def share_of_capitals(texts):
    return texts.str.count("[A-Z]") / texts.str.len().clip(lower=1)


@query(
    "scorer_plugin",
    f"""
    SELECT doc_id, CASE WHEN risk < 0.03 THEN text END AS sanitized, {sql.scored('risk', 0.03)}
    FROM (SELECT doc_id, text, round({sql.hits('text', '[A-Z]')} / greatest(length(text), 1), 6) AS risk FROM documents)
    """,
)
def scorer_plugin(spark, folder):
    """A scorer over Arrow batches in the place of a word list."""
    rule = scored.scorer_rule("capitals", share_of_capitals, 0.03)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)
