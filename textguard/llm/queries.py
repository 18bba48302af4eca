"""The registered queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.llm import (
    extraction,
    minhash,
    mixing,
    preferences,
    quality,
    repair,
    resampling,
    secrets,
    sharding,
    substrings,
    toxicity,
    warc,
    winnow,
)
from textguard.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _hashed(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 12))::BIGINT"


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    {_hashed("'mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))")} AS h
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM sizes),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(place % 3 + 1)::INT]::DOUBLE AS weight, 2.0 * source_size::DOUBLE AS top
  FROM placed),
leveled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(top) OVER (ORDER BY top / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY top / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
settled AS (
  SELECT level FROM leveled WHERE top > level * weight ORDER BY top / weight, place LIMIT 1),
targets AS (
  SELECT source, source_size,
    least(top, coalesce((SELECT level FROM settled) * weight, top))::DOUBLE AS target FROM leveled),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
  FROM targets),
wanted AS (SELECT *, target - whole * source_size AS missing FROM wholes),
values_ AS (SELECT source, h, sum(size) AS words FROM rows GROUP BY source, h),
running AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM values_),
crossed AS (
  SELECT w.source, min(struct_pack(h := r.h, words := r.words, rest := w.missing - (r.upto - r.words))) AS b
  FROM wanted w JOIN running r ON w.source IS NOT DISTINCT FROM r.source
  WHERE w.missing > 0 AND r.upto >= w.missing GROUP BY w.source),
limits AS (
  SELECT w.*, CASE WHEN b.words - b.rest <= b.rest THEN b.h + 1 ELSE b.h END AS lim
  FROM wanted w LEFT JOIN crossed c ON w.source IS NOT DISTINCT FROM c.source),
decided AS (
  SELECT r.doc_id, r.source, r.size, l.source_size, l.target,
    CASE WHEN r.size > 0 THEN l.whole + CASE WHEN r.h < l.lim THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS copies
  FROM rows r JOIN limits l ON r.source IS NOT DISTINCT FROM l.source)
SELECT *, copies * size AS taken FROM decided
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


_OWNERS = ", ".join(
    f"({slot}, '{shard}')" for slot, shard in enumerate(sharding.slot_owners())
)
SHARD_SQL = f"""
WITH owners(slot, shard) AS (VALUES {_OWNERS}),
placed AS (
  SELECT doc_id, ({_hashed("'shard:' || coalesce(doc_id::VARCHAR, 'null')")}
    % {sharding.SLOTS})::INTEGER AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN owners USING (slot)
"""


@query("op4_shard_lookup", SHARD_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def _em_sql() -> str:
    """The same rounds of expectation-maximisation, one pair of tables per round."""
    rules = list(enumerate(quality.RULES, 1))
    start = ", ".join(f"{accuracy!r}::DOUBLE AS a{rule}" for rule, (_, _, accuracy) in rules)
    prior = f"ln({quality.GOOD_SHARE!r}::DOUBLE / (1 - {quality.GOOD_SHARE!r}::DOUBLE))"
    odds = " + ".join([prior] + [f"v[{rule}] * ln(a{rule} / (1 - a{rule}))" for rule, _ in rules])
    parts = [f"m0 AS MATERIALIZED (SELECT {start})"]
    for number in range(quality.ROUNDS + 1):
        parts.append(
            f"w{number} AS MATERIALIZED (SELECT v, n, 1 / (1 + exp(-({odds}))) AS w FROM patterns, m{number})"
        )
        accuracies = ", ".join(
            f"({quality.PSEUDO * accuracy!r}::DOUBLE + coalesce(sum(CASE WHEN v[{rule}] <> 0 THEN n * "
            f"({accuracy!r}::DOUBLE + CASE WHEN v[{rule}] > 0 THEN w ELSE 1 - w END) END), 0)) / "
            f"({quality.PSEUDO!r}::DOUBLE + coalesce(sum(CASE WHEN v[{rule}] <> 0 THEN 2 * n END), 0)) AS a{rule}"
            for rule, (_, _, accuracy) in rules
        )
        parts.append(f"m{number + 1} AS MATERIALIZED (SELECT {accuracies} FROM w{number})")
    return ",\n".join(parts)


QUALITY_SQL = rf"""
WITH tokens AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {WORDS} AS ws FROM documents),
windows AS (
  SELECT r, i, list_slice(ws, i, i + {quality.WINDOW - 1}) AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i FROM tokens)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
repeated AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + {quality.WINDOW})) AS p FROM twice) GROUP BY r),
counts AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    len(regexp_extract_all(body, '\p{{Lu}}'))::BIGINT AS n_capitals,
    (length(body) - length(replace(body, '!', '')))::BIGINT AS n_exclamations,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutters
  FROM tokens),
measured AS (
  SELECT r, doc_id, n_words, word_chars, n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    n_capitals, n_exclamations, n_stutters
  FROM counts LEFT JOIN repeated USING (r)),
voted AS (
  SELECT *, [
    CASE WHEN n_symbols * 10 > n_words THEN -1 ELSE 0 END,
    CASE WHEN n_capitals * 2 > word_chars THEN -1 ELSE 0 END,
    CASE WHEN n_exclamations * 4 > n_words THEN -1 ELSE 0 END,
    CASE WHEN n_stutters * 5 > n_words THEN -1 ELSE 0 END,
    CASE WHEN n_repeat_words * 100 > n_words * {quality.REPEAT_PERCENT} THEN -1 ELSE 0 END,
    CASE WHEN n_dup_lines * 2 > n_lines THEN -1 ELSE 0 END,
    CASE WHEN word_chars > n_words * 40 THEN -1 ELSE 0 END,
    CASE WHEN n_symbols * 10 <= n_words AND n_symbols * 50 > n_words THEN -1 ELSE 0 END,
    CASE WHEN n_capitals * 2 <= word_chars AND n_capitals * 5 > word_chars THEN -1 ELSE 0 END,
    CASE WHEN n_repeat_words * 100 <= n_words * {quality.REPEAT_PERCENT}
      AND n_repeat_words * 100 > n_words * 15 THEN -1 ELSE 0 END,
    CASE WHEN word_chars BETWEEN n_words * 2 AND n_words * 12 THEN 1 ELSE 0 END] AS v
  FROM measured),
patterns AS MATERIALIZED (SELECT v, count(*) AS n FROM voted GROUP BY v),
{_em_sql()},
judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(w, 4) AS posterior,
    w >= 0.5 AS likely, (n_words < {quality.MIN_WORDS}
      OR n_repeat_words * 100 > n_words * {quality.REPEAT_PERCENT}) AS base_failed
  FROM voted JOIN w{quality.ROUNDS} USING (v))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, posterior, base_failed,
  NOT base_failed AND likely AS kept FROM judged
"""


@query("op5_quality_rules", QUALITY_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "measured.n_words",
        "measured.word_chars",
        "measured.n_symbols",
        "measured.n_dup_lines",
        "measured.n_repeat_words",
        F.round("posterior", 4).alias("posterior"),
        "base_failed",
        "kept",
    )


PREFERENCE_SQL = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
pairs AS (
  SELECT a.conv_id // 2 AS pair_id, a.conv_id AS chosen, b.conv_id AS rejected
  FROM ids a JOIN ids b ON b.conv_id = a.conv_id + 1 WHERE a.conv_id % 2 = 0),
sides AS (
  SELECT pair_id, 'chosen' AS side, chosen AS conv_id FROM pairs
  UNION ALL SELECT pair_id, 'rejected', rejected FROM pairs),
placed AS (
  SELECT s.pair_id, s.side, c.turn::BIGINT AS turn, coalesce(c.role, 'none') AS role,
    coalesce(c.text, '') AS body, c.text IS NULL AS none
  FROM conversations c JOIN sides s USING (conv_id) WHERE c.turn IS NOT NULL),
first AS (
  SELECT pair_id, min(turn) AS f FROM (
    SELECT pair_id, turn FROM placed GROUP BY pair_id, turn, role, body, none
    HAVING sum(CASE side WHEN 'chosen' THEN 1 ELSE -1 END) <> 0) GROUP BY pair_id),
sections AS (
  SELECT p.*, CASE WHEN f IS NULL OR turn < f THEN 'prompt' ELSE side END AS section
  FROM placed p LEFT JOIN first USING (pair_id)),
rendered AS (
  SELECT *, '<|' || role || '|>' || chr(10) AS head FROM sections
  WHERE section <> 'prompt' OR side = 'chosen')
SELECT pair_id, section, turn, role, head || body || '<|end|>' || chr(10) AS rendered,
  CASE WHEN section <> 'prompt' AND role = 'assistant' THEN length(head) ELSE 0 END::INTEGER AS mask_start,
  CASE WHEN section <> 'prompt' AND role = 'assistant' THEN length(head) + length(body) + 7 ELSE 0 END::INTEGER
    AS mask_end
FROM rendered
"""


@query("op6_preference_pairs", PREFERENCE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return preferences.format_preferences(conversations, preferences.pair_neighbours(conversations))


BRANCH_SQL = (
    """
WITH turns AS (
  SELECT conv_id AS conv, turn::BIGINT AS turn, role, text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answers AS (SELECT conv, max(turn) AS place FROM turns WHERE role = 'assistant' GROUP BY conv),
following AS (
  SELECT *, coalesce(lead(conv) OVER (ORDER BY conv), min(conv) OVER ()) AS giver FROM answers),
branches AS (
  SELECT f.conv, f.place, f.giver, a.place AS given FROM following f JOIN answers a ON a.conv = f.giver
  WHERE f.conv <> f.giver),
branched AS (
  SELECT conv, 0 AS half, turn, role, text FROM turns JOIN branches USING (conv)
  UNION ALL SELECT conv, 1, turn, role, text FROM turns JOIN branches USING (conv) WHERE turn < place
  UNION ALL SELECT b.conv, 1, b.place, t.role, t.text
  FROM branches b JOIN turns t ON t.conv = b.giver AND t.turn = b.given WHERE t.role = 'assistant'),
placed AS (
  SELECT conv AS pair_id, CASE half WHEN 0 THEN 'chosen' ELSE 'rejected' END AS side, turn,
    coalesce(role, 'none') AS role, coalesce(text, '') AS body, text IS NULL AS none FROM branched),
"""
    + PREFERENCE_SQL[PREFERENCE_SQL.index("first AS (") :]
)


@query("op6_preference_branches", BRANCH_SQL)
def op6_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    branched = preferences.branch(table(spark, sf_dir, "conversations"))
    return preferences.format_preferences(branched, preferences.pair_branches(branched))


_ORDER = "turn, role, rendered, mask_start, mask_end"
EXAMPLE_SQL = f"""
WITH formatted AS ({BRANCH_SQL}),
placed AS (
  SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, section ORDER BY {_ORDER}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM formatted)
SELECT pair_id,
  {", ".join(f"coalesce(string_agg(rendered, '' ORDER BY {_ORDER}) FILTER (section = '{name}'), '') AS {name}"
             for name in ("prompt", "chosen", "rejected"))},
  {", ".join("coalesce(string_agg((start + mask_start) || '-' || (start + mask_end), ',' ORDER BY start) "
             f"FILTER (section = '{name}' AND mask_end > mask_start), '') AS {name}_masks"
             for name in ("chosen", "rejected"))}
FROM placed GROUP BY pair_id
"""


@query("op6_preference_examples", EXAMPLE_SQL)
def op6_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    branched = preferences.branch(table(spark, sf_dir, "conversations"))
    formatted = preferences.format_preferences(branched, preferences.pair_branches(branched))

    def spans(masks: str):
        return F.array_join(F.transform(masks, lambda m: F.concat_ws("-", m["start"], m["end"])), ",")

    examples = preferences.assemble(formatted)
    return examples.withColumns({name: spans(name) for name in ("chosen_masks", "rejected_masks")})


def _plain_words(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


DECONTAMINATION_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_plain_words("text")} AS ws FROM documents),
items AS (SELECT item_id, {_plain_words("text")} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, list_slice(ws, i, i + n - 1) AS win FROM (
    SELECT item_id, ws, least(len(ws), {winnow.WINDOW}) AS n,
      unnest(range(1, len(ws) - least(len(ws), {winnow.WINDOW}) + 2)) AS i
    FROM items WHERE len(ws) > 0)),
spans AS (
  SELECT r, n, i, list_slice(ws, i, i + n - 1) AS win FROM (
    SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
    FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(ws) >= n)),
hits AS (SELECT r, s.n, i, item_id FROM spans s JOIN item_windows w ON s.n = w.n AND s.win = w.win),
words AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT item_id)::BIGINT AS n_items,
    array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""


@query("op8_benchmark_decontamination", DECONTAMINATION_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    verdicts = winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return verdicts.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op10_minmax_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_repeated_substrings")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin([rule.name for rule in secrets.BASE_RULES]))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


WARC_SQL = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM payloads
  WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END
    AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


@query("op2_warc_bundles", WARC_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_toxic_spans")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def _crc_sql(keys: str) -> str:
    """Tables that give ``crc`` (key, value): CRC-32 of the UTF-8 bytes of each key, byte by byte."""
    step = "CASE WHEN {v} % 2 = 1 THEN xor({v} // 2, 3988292384::BIGINT) ELSE {v} // 2 END AS {v}"
    rounds = "SELECT b, b AS v FROM (SELECT unnest(range(256)) AS b)"
    for _ in range(8):
        rounds = f"SELECT b, {step.format(v='v')} FROM ({rounds})"
    return f"""
crc_bytes AS MATERIALIZED ({rounds}),
crc_keys AS MATERIALIZED (SELECT DISTINCT k, hex(encode(k)) AS x FROM ({keys})),
crc_steps(k, x, p, v) AS (
  SELECT k, x, 0, 4294967295::BIGINT FROM crc_keys
  UNION ALL
  SELECT k, x, p + 1, xor(s.v // 256, b.v) FROM crc_steps s JOIN crc_bytes b
    ON b.b = xor(s.v % 256, ('0x' || substr(x, 2 * p + 1, 2))::BIGINT) WHERE 2 * p < length(x)),
crc AS MATERIALIZED (
  SELECT k, xor(v, 4294967295::BIGINT) AS value FROM crc_steps WHERE 2 * p = length(x))"""


RESAMPLE_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT true AS mine, row_number() OVER () AS r, doc_id, {_plain_words("text")} AS ws FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, {_plain_words("text")} FROM benchmark),
features AS MATERIALIZED (
  SELECT mine, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])))
    AS k FROM texts),
{_crc_sql("SELECT k FROM features")},
placed AS MATERIALIZED (
  SELECT mine, r, value % {resampling.BUCKETS} AS bucket, count(*) AS n
  FROM features JOIN crc USING (k) GROUP BY ALL),
buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (mine), 0)::DOUBLE AS s,
    coalesce(sum(n) FILTER (NOT mine), 0)::DOUBLE AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + {resampling.BUCKETS})
    / ((s + 1) * (sum(t) OVER () + {resampling.BUCKETS}))))::BIGINT AS gain FROM buckets),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
  FROM placed JOIN gains USING (bucket) WHERE mine GROUP BY r),
scored AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(floor(total / n_features), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE AS h
  FROM texts LEFT JOIN weights USING (r) WHERE mine),
noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, weight, n_features)
    AS place, 25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS most FROM noisy)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= most THEN place END::BIGINT AS rank FROM drawn
"""


@query("op11_importance_resampling", RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"))


def _edit(entry: str, cost: str, letter: str) -> str:
    """An entry of nine digits of cost and then an audit, after one more edit; NULL stays NULL."""
    return f"(lpad((substr({entry}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({entry}, 10) || '{letter}')"


_CLOSED = f"""
  SELECT *, least(ca, {_edit("eu", "2", "I")}) AS ea FROM (
    SELECT *, least(cu, {_edit("c0", "2", "I")}, {_edit("cs", "2", "I")}, {_edit("ca", "2", "I")}) AS eu
    FROM steps)"""
REPAIR_SQL = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS c, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
{_crc_sql("SELECT k FROM base")},
coded AS (SELECT base.*, value % 20 AS code FROM base JOIN crc USING (k)),
damaged AS (
  SELECT conv_id, c, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
placed AS (
  SELECT *, substr(role, 1, 1) AS i,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS p,
    row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
faults AS MATERIALIZED (
  SELECT *, fault IN ('none', 'truncated') AS stays, (fault = 'truncated')::BIGINT AS more,
    lag(i) OVER (PARTITION BY c ORDER BY p) AS before FROM (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
      WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE 'none' END AS fault
    FROM placed)),
counts AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c),
steps(c, p, c0, cs, cu, ca) AS (
  SELECT c, 0::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counts
  UNION ALL
  SELECT e.c, f.p, {_edit("c0", "3", "D")},
    least({_edit("cs", "3", "D")}, CASE WHEN stays AND i = 's' THEN {_edit("c0", "more", "K")} END),
    least({_edit("eu", "3", "D")}, CASE WHEN stays THEN {_edit("least(c0, cs, ea)", "2 + more", "R")} END,
      CASE WHEN stays AND i = 'u' THEN {_edit("least(c0, cs, ea)", "more", "K")} END),
    least({_edit("ea", "3", "D")}, CASE WHEN stays THEN {_edit("eu", "2 + more", "R")} END,
      CASE WHEN stays AND i = 'a' THEN {_edit("eu", "more", "K")} END)
  FROM ({_CLOSED}) e JOIN faults f ON f.c = e.c AND f.p = e.p + 1),
best AS MATERIALIZED (
  SELECT c, substr(entry, 1, 9)::BIGINT AS cost, substr(entry, 10) AS audit FROM (
    SELECT e.c, least(c0, ea) AS entry FROM ({_CLOSED}) e JOIN counts n ON n.c = e.c AND n.n = e.p)),
walk(c, audit, at_, p, state, body) AS (
  SELECT c, audit, 1::BIGINT, 0::BIGINT, '0', NULL::VARCHAR FROM best
  UNION ALL
  SELECT c, audit, at_ + 1, p, CASE edit WHEN 'D' THEN state WHEN 'K' THEN i ELSE substr(needed, 1, 1) END,
    CASE WHEN edit = 'D' THEN body ELSE coalesce(body || chr(10), '')
      || CASE edit WHEN 'K' THEN role ELSE needed END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END END
  FROM (
    SELECT w.c, audit, at_, state, body, substr(audit, at_, 1) AS edit, f.i, f.role, f.text,
      CASE state WHEN 'u' THEN 'assistant' ELSE 'user' END AS needed,
      w.p + (substr(audit, at_, 1) <> 'I')::BIGINT AS p
    FROM walk w LEFT JOIN faults f ON f.c = w.c AND f.p = w.p + 1 WHERE at_ <= length(audit))),
repaired AS (SELECT c, cost, audit, body FROM walk JOIN best USING (c, audit) WHERE at_ > length(audit))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM base) LEFT JOIN counts USING (c) LEFT JOIN repaired USING (c)
"""


@query("op13_conversation_repair", REPAIR_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), copies="copies")


def _decoded(text: str) -> str:
    """The character references that the pages' articles hold; the ampersand comes last."""
    for pattern, sign in (("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&#x27;?|&#39;?", "''"), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{pattern}', '{sign}', 'g')"
    return text


# Pages of the given tables mark their article by an element, so their main text can also be cut
# out by patterns, without any of the operator's rules.
EXTRACTION_SQL = rf"""
WITH parts AS (
  SELECT page_id, url, string_split_regex(
    regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'),
    '</?(?:p|h1)>') AS parts FROM pages),
blocks AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(
    {_decoded("regexp_replace(x, '<[^>]*>', '', 'g')")}, '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM parts)
SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text,
  length(array_to_string(blocks, chr(10) || chr(10)))::BIGINT AS n_chars FROM blocks
"""


@query("op12_html_extraction", EXTRACTION_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))
