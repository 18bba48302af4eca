"""Standardizing the field names of JSON documents made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query, sql
from textguard.functions import wordlists as wl
from textguard.plans import key_clusters as kc
from textguard.plans import key_names as kn
from textguard.plans import key_paths as kp
from textguard.plans import key_vectors as kv
from textguard.plans import standardize as st
from textguard.session import new_path, spread, spread_rows, stage
from textguard.sources.json_folder import json_files, parse_documents
from textguard.sources.tables import table

# One JSON text per row; the same expressions run in Spark and in the oracle.
DOCUMENTS = {
    "orders": """concat('{"orderKey":', o_orderkey, ',"customer":{"customer_key":', o_custkey,
        ',"orderPriority":"', o_orderpriority, '"},"key_values":[{"key":"Order ', o_orderpriority,
        '","value":1},{"key":"', o_orderstatus, ' order status"},{"key":7}]}')""",
    "part": """concat('{"partKey":', p_partkey, ',"specs":{"', p_name, '":{"partSize":', p_size,
        ',"', lower(p_type), 'Type":null}},"items":[{"item_brand":"', p_brand,
        '"},3,[{"hidden":1}]],"key_values":[{"key":"', p_name, ' ', p_type, '"},{"key":"',
        replace(p_name, ' ', '_'), '"},{"value":"none"}]}')""",
    "events": """concat('{"eventType":"', event_type, '","user_id":', user_id, ',"', event_type,
        'Info":', props, ',"sessions":[{"sessionLength":', user_id, '},{"session_length":1}]}')""",
    "benchmark": """concat('{"key_values":[{"key":"',
        replace(replace(text, chr(10), ' '), ' ', '"},{"key":"'), '"}]}')""",
    "region": """concat('{"region":"', r_name, '",')""",
}


def json_rows(spark, folder):
    rows = None
    for name, text in DOCUMENTS.items():
        some = spread_rows(table(spark, folder, name)).selectExpr(f"'{name}' AS path", f"{text} AS j")
        rows = some if rows is None else rows.union(some)
    return rows


def json_documents(spark, folder):
    return parse_documents(json_rows(spark, folder), F.col("path"), F.col("j"))


def some_keys(spark, folder):
    return kp.distinct_keys(kp.document_samples(json_documents(spark, folder)))


RAW = " UNION ALL ".join(
    f"SELECT '{name}' AS path, {text} AS j FROM {name}" for name, text in DOCUMENTS.items()
)
STOP = sql.listed(wl.KEY_STOP_WORDS)


def clean_sql(key: str) -> str:
    plain = rf"regexp_replace({key}, '[^a-zA-Z\s_]', ' ', 'g')"
    split = rf"regexp_replace({plain}, '([a-z])([A-Z])', '\1 \2', 'g')"
    return rf"trim(regexp_replace(lower(replace({split}, '_', ' ')), '\s+', ' ', 'g'))"


def name_sql(key: str) -> str:
    plain = rf"regexp_replace({key}, '[^a-zA-Z\s]', ' ', 'g')"
    split = rf"lower(regexp_replace({plain}, '([a-z])([A-Z])', '\1 \2', 'g'))"
    words = f"regexp_extract_all({split}, '[a-z]+')"
    telling = f"list_filter({words}, lambda w: w NOT IN ({sql.listed(wl.NAME_STOP_WORDS)}) AND length(w) > 2)"
    return (
        f"array_to_string(CASE WHEN len({telling}) > 0 THEN ({telling})[1:4] ELSE ({words})[1:3] END, '_')"
    )


KEYS = f"""
    docs AS MATERIALIZED (SELECT j FROM ({RAW}) WHERE json_valid(j)),
    listed AS (
        SELECT DISTINCT json_extract_string(e, '$.key') AS key
        FROM (
            SELECT unnest(CAST(json_extract(j, '$.key_values') AS JSON[])) AS e FROM docs
            WHERE json_type(j, '$.key_values') = 'ARRAY'
        )
        WHERE json_type(e, '$.key') = 'VARCHAR'
    ),
    nested AS (
        SELECT DISTINCT replace(regexp_replace(substr(fullkey, 3), '\\[[0-9]+\\]', '', 'g'), '"', '') AS key
        FROM docs, json_tree(docs.j)
        WHERE json_type(docs.j) = 'OBJECT' AND fullkey <> '$' AND NOT contains(fullkey, '][')
            AND fullkey NOT LIKE '%]'
    ),
    keys AS MATERIALIZED (SELECT key FROM listed UNION SELECT key FROM nested)
"""
VECTORS = f"""
    cleaned AS MATERIALIZED (SELECT key, {clean_sql('key')} AS clean FROM keys),
    names AS (SELECT clean, count(*) AS n_keys FROM cleaned GROUP BY clean),
    tokens AS (
        SELECT clean, n_keys, list_filter(string_split(clean, ' '),
            lambda w: length(w) >= 2 AND w NOT IN ({STOP})) AS t
        FROM names
    ),
    terms AS MATERIALIZED (
        SELECT clean, n_keys, term, count(*) AS tf
        FROM (
            SELECT clean, n_keys, unnest(list_concat(t, list_transform(range(1, len(t)),
                lambda i: t[i] || ' ' || t[i + 1]))) AS term
            FROM tokens
        )
        GROUP BY clean, n_keys, term
    ),
    vocab AS (
        SELECT term, sum(n_keys)::BIGINT AS df, (SELECT count(*) FROM keys) AS n
        FROM terms GROUP BY term HAVING sum(n_keys) <= 0.8 * (SELECT count(*) FROM keys)
    ),
    raw_weights AS (
        SELECT clean, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM terms JOIN vocab USING (term)
    ),
    weights AS MATERIALIZED (
        SELECT clean, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY clean)) AS weight FROM raw_weights
    ),
    edges AS MATERIALIZED (
        SELECT a.clean AS a, b.clean AS b, round(sum(a.weight * b.weight), 9) AS cosine
        FROM weights a JOIN weights b ON a.term = b.term AND a.clean < b.clean
        GROUP BY a.clean, b.clean HAVING round(sum(a.weight * b.weight), 9) >= 0.7
    )
"""
CLUSTERS = """
    links AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach(x, y) AS (
        SELECT a, b FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a
    ),
    labels AS (
        SELECT clean, least(clean, min(y)) AS label
        FROM (SELECT DISTINCT clean FROM weights) JOIN names USING (clean)
            LEFT JOIN reach ON clean = x
        WHERE n_keys >= 2 OR y IS NOT NULL GROUP BY clean
    ),
    smallest AS (
        SELECT label, row_number() OVER (ORDER BY min(key)) - 1 AS cluster_id
        FROM cleaned JOIN labels USING (clean) GROUP BY label
    ),
    clusters AS MATERIALIZED (
        SELECT key, coalesce(cluster_id, -1) AS cluster_id
        FROM cleaned LEFT JOIN labels USING (clean) LEFT JOIN smallest USING (label)
    )
"""
NAMES = f"""
    named AS (
        SELECT key, cluster_id, CASE WHEN cluster_id = -1 THEN key ELSE 'cluster_' || cluster_id END AS name_key
        FROM clusters
    ),
    standard AS (
        SELECT name_key, cluster_id, {name_sql('longest')} AS standard_key
        FROM (
            SELECT name_key, cluster_id, (list(key ORDER BY -length(key), key))[1] AS longest
            FROM named GROUP BY name_key, cluster_id
        )
    ),
    mapping AS (SELECT key, cluster_id, name_key, standard_key FROM named JOIN standard USING (name_key, cluster_id))
"""
WITH_KEYS = f"WITH {KEYS}"
WITH_VECTORS = f"WITH {KEYS}, {VECTORS}"
WITH_CLUSTERS = f"WITH RECURSIVE {KEYS}, {VECTORS}, {CLUSTERS}"
WITH_NAMES = f"{WITH_CLUSTERS}, {NAMES}"

# --- documents and keys ---------------------------------------------------------------

SUPPLIER = """concat('{"suppKey":', s_suppkey, ',"balance":', cast(s_acctbal AS int),
    CASE WHEN s_nationkey < 5 THEN ',' ELSE '}' END)"""


@query(
    "json_folder_load",
    "SELECT s_suppkey AS supp_key, s_nationkey >= 5 AS usable FROM supplier",
)
def json_folder_load(spark, folder):
    """Writes one file per supplier to the work folder and loads them again."""
    path = new_path(spark, "json")
    rows = spread(table(spark, folder, "supplier").selectExpr(f"{SUPPLIER} AS value"))
    # Tasks put their files in place themselves; the driver would rename one after the other.
    write = rows.write.option("maxRecordsPerFile", 1)
    write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    good_key = F.try_variant_get("data", "$.suppKey", "bigint")
    bad_key = F.regexp_extract("value", '"suppKey":([0-9]+)', 1).cast("long")
    usable = F.col("data").isNotNull()
    return json_files(spark, path, "part-*").select(
        F.when(usable, good_key).otherwise(bad_key).alias("supp_key"), usable.alias("usable")
    )


@query("kv_keys", f"{WITH_KEYS} SELECT key FROM listed")
def kv_keys(spark, folder):
    samples = kp.document_samples(json_documents(spark, folder))
    return samples.filter("kind = 'key'").select(F.col("name").alias("key"))


@query("json_key_paths", f"{WITH_KEYS} SELECT key FROM nested")
def json_key_paths(spark, folder):
    return kp.nested_paths(kp.document_samples(json_documents(spark, folder)))


@query("distinct_keys", f"{WITH_KEYS} SELECT key FROM keys")
def distinct_keys(spark, folder):
    return some_keys(spark, folder)


@query("key_normalize", f"{WITH_KEYS} SELECT key, {clean_sql('key')} AS clean FROM keys")
def key_normalize(spark, folder):
    return some_keys(spark, folder).select("key", kv.clean_key(F.col("key")).alias("clean"))


@query("key_heuristic_name", f"{WITH_KEYS} SELECT key, {name_sql('key')} AS standard_key FROM keys")
def key_heuristic_name(spark, folder):
    keys = some_keys(spark, folder)
    return keys.select("key", kn.standard_name(F.col("key")).alias("standard_key"))


# --- vectors --------------------------------------------------------------------------


def names_and_counts(spark, folder):
    names = stage(kv.clean_names(some_keys(spark, folder)), "names")
    return names, stage(kv.term_counts(names), "terms")


def key_weights(spark, folder):
    names, counts = names_and_counts(spark, folder)
    return stage(kv.tfidf(counts, stage(kv.vocabulary(names, counts), "vocabulary")), "weights")


@query("key_ngrams", f"{WITH_VECTORS} SELECT clean, n_keys, term, tf FROM terms")
def key_ngrams(spark, folder):
    return names_and_counts(spark, folder)[1]


@query("key_vocab", f"{WITH_VECTORS} SELECT term, df, n FROM vocab")
def key_vocab(spark, folder):
    return kv.vocabulary(*names_and_counts(spark, folder))


@query("key_tfidf", f"{WITH_VECTORS} SELECT clean, term, round(weight, 6) AS weight FROM weights")
def key_tfidf(spark, folder):
    weights = key_weights(spark, folder)
    return weights.select("clean", "term", F.round("weight", 6).alias("weight"))


@query("key_similarity", f"{WITH_VECTORS} SELECT a, b, round(cosine, 6) AS cosine FROM edges")
def key_similarity(spark, folder):
    edges = kv.similar_names(key_weights(spark, folder))
    return edges.withColumn("cosine", F.round("cosine", 6))


# --- clusters and names -----------------------------------------------------------------


def key_clusters_of(spark, folder):
    return stage(kc.cluster_keys(some_keys(spark, folder)), "clusters")


@query("key_clusters", f"{WITH_CLUSTERS} SELECT key, cluster_id FROM clusters")
def key_clusters(spark, folder):
    return key_clusters_of(spark, folder)


FLAGS = "SELECT l_returnflag AS key FROM lineitem UNION SELECT l_linestatus FROM lineitem"


@query(
    "key_clusters_fallback",
    f"SELECT key, row_number() OVER (ORDER BY key) - 1 AS cluster_id FROM ({FLAGS})",
)
def key_clusters_fallback(spark, folder):
    """One-letter keys leave no term to compare."""
    lines = table(spark, folder, "lineitem")
    flags = lines.select(F.col("l_returnflag").alias("key")).union(lines.select("l_linestatus"))
    return kc.cluster_keys(flags.distinct())


def standard_map_of(spark, folder, overrides=None):
    clusters = key_clusters_of(spark, folder)
    return kn.standard_map(clusters, stage(kn.cluster_names(clusters, overrides), "names"))


@query("cluster_names", f"{WITH_NAMES} SELECT name_key, cluster_id, standard_key FROM standard")
def cluster_names(spark, folder):
    names = kn.cluster_names(key_clusters_of(spark, folder))
    return names.select("name_key", "cluster_id", "standard_key")


@query("key_standard_map", f"{WITH_NAMES} SELECT * FROM mapping")
def key_standard_map(spark, folder):
    return standard_map_of(spark, folder)


GIVEN = "concat('given_', lower(replace(p_name, ' ', '_')))"


@query(
    "key_override",
    f"""{WITH_NAMES}, given AS (
        SELECT DISTINCT replace(concat('specs.', p_name), ' ', ' ') AS name_key, {GIVEN} AS given FROM part
        UNION
        SELECT DISTINCT concat('cluster_', p_size), {GIVEN} FROM part WHERE p_partkey < p_size
    ), one AS (SELECT name_key, min(given) AS given FROM given GROUP BY name_key)
    SELECT key, cluster_id, name_key, coalesce(given, standard_key) AS standard_key
    FROM mapping LEFT JOIN one USING (name_key)
    """,
)
def key_override(spark, folder):
    part = table(spark, folder, "part")
    given = part.selectExpr("concat('specs.', p_name) AS name_key", f"{GIVEN} AS standard_key").union(
        part.filter("p_partkey < p_size").selectExpr("concat('cluster_', p_size)", GIVEN)
    )
    one = given.groupBy("name_key").agg(F.min("standard_key").alias("standard_key"))
    return standard_map_of(spark, folder, one)


@query(
    "key_grouped_mapping",
    f"""{WITH_NAMES}
    SELECT standard_key, 0::BIGINT AS part, array_to_string(list(key ORDER BY key), '|') AS keys
    FROM mapping GROUP BY standard_key
    """,
)
def key_grouped_mapping(spark, folder):
    grouped = kn.grouped_map(standard_map_of(spark, folder))
    return grouped.withColumn("keys", F.array_join("keys", "|"))


@query(
    "key_preview",
    f"{WITH_NAMES} SELECT key, standard_key FROM mapping ORDER BY key LIMIT 10",
)
def key_preview(spark, folder):
    return st.preview(standard_map_of(spark, folder))


REPORT = """
    SELECT (SELECT count(*) FROM docs) AS total_files, count(*) AS total_keys,
        count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS total_clusters,
        count(*) FILTER (cluster_id = -1) AS noise_keys
    FROM mapping
"""


@query("key_report", f"{WITH_NAMES} SELECT *, 'ok' AS status FROM ({REPORT})")
def key_report(spark, folder):
    return st.standardize_documents(json_documents(spark, folder)).report


@query("key_standardize", f"{WITH_NAMES} SELECT * FROM mapping")
def key_standardize(spark, folder):
    """The whole job, with its results saved and read back."""
    result = st.standardize_documents(json_documents(spark, folder))
    run = st.save_results(result, new_path(spark, "results"))
    return spark.read.schema(result.mapping.schema).json(f"{run}/mapping")


@query(
    "key_standardize_empty",
    "SELECT 0::BIGINT AS total_files, 0::BIGINT AS total_keys, 0::BIGINT AS total_clusters,"
    " 0::BIGINT AS noise_keys, 'no usable JSON documents' AS status",
)
def key_standardize_empty(spark, folder):
    """Orders by themselves are no JSON, so every document is left out."""
    orders = spread(table(spark, folder, "orders").select("o_orderstatus"))
    parsed = parse_documents(orders, F.lit("orders"), F.col("o_orderstatus"))
    return st.standardize_documents(parsed).report
