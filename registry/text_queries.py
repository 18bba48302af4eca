"""Rules over single texts and prompt/output pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import query, sql
from registry.samples import BANNED, CUES
from textguard.functions import text as tx
from textguard.functions import wordlists as wl
from textguard.functions.wordlists import Entry
from textguard.operators import language as lang
from textguard.operators import pii, scored, vault
from textguard.operators import text_rules as rules
from textguard.operators.rule import (
    Rule,
    compose,
    scan,
    split_valid,
    violation_report,
    violation_rollup,
)
from textguard.sources.pairs import conversation_pairs
from textguard.sources.tables import table, text_table
from textguard.session import spread


def documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return text_table(spark, folder, "documents", "doc_id", "text", *more)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_pairs(text_table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))


def verdicts(df: DataFrame, keys: Sequence[str], text: str, rule: Rule, *details: str) -> DataFrame:
    done = scan(df, text, rule, out=["scan"])
    fields = ["sanitized", "is_valid", "risk_score", *details]
    return done.select(*keys, *[f"scan.{name}" for name in fields])


# --- pairs and sentences ----------------------------------------------------


@query("conv_pairs", sql.PAIRS)
def conv_pairs(spark, folder):
    return pairs(spark, folder)


@query(
    "sentence_split",
    f"""
    SELECT doc_id, unnest(s) AS sentence, CAST(unnest(range(len(s))) AS INTEGER) AS pos
    FROM (SELECT doc_id, {sql.sentences('text')} AS s FROM documents)
    """,
)
def sentence_split(spark, folder):
    df = documents(spark, folder)
    return df.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))


# --- patterns and terms -----------------------------------------------------

SHAPE = "[A-Z][^0-9]*"


@query(
    "regex_match",
    f"""
    SELECT doc_id, CASE WHEN ok THEN text END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (SELECT doc_id, text, regexp_full_match(text, '(?s){SHAPE}') AS ok FROM documents)
    """,
)
def regex_match(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", rules.regex_match(SHAPE))


BLOCKED = [r"Bearer [A-Za-z0-9-._~+/]+", 'token = "[0-9a-f]{40}"']


@query(
    "regex_scan_redact",
    f"""
    SELECT doc_id, {sql.replaced(sql.replaced('text', BLOCKED[0], '[REDACTED]'), BLOCKED[1], '[REDACTED]')}
        AS sanitized, {sql.yes_no(' OR '.join(sql.matches('text', p) for p in BLOCKED))}
    FROM documents
    """,
)
def regex_scan_redact(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", rules.regex_scan(BLOCKED))


@query(
    "ban_substrings_str",
    f"""
    SELECT doc_id, {sql.replaced('text', f'(?i)(?:{tx.any_of(BANNED)})', '[REDACTED]')} AS sanitized,
        {sql.yes_no(sql.matches('text', f'(?i)(?:{tx.any_of(BANNED)})'))}
    FROM documents
    """,
)
def ban_substrings_str(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", rules.ban_substrings(BANNED))


@query(
    "ban_substrings_word",
    f"""
    SELECT doc_id, {sql.replaced('text', sql.bounded(tx.any_of(BANNED)), '[REDACTED]')} AS sanitized,
        {sql.yes_no(sql.matches('text', sql.bounded(tx.any_of(BANNED))))}
    FROM documents
    """,
)
def ban_substrings_word(spark, folder):
    rule = rules.ban_substrings(BANNED, match_type="word", case_sensitive=True)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)


EVERY = ["the", "of", "with", "thing"]


@query(
    "ban_substrings_all",
    f"""
    SELECT doc_id, text AS sanitized,
        {sql.yes_no(' AND '.join(sql.matches('text', f'(?i){term}') for term in EVERY))}
    FROM documents
    """,
)
def ban_substrings_all(spark, folder):
    rule = rules.ban_substrings(EVERY, redact=False, contains_all=True)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)


@query(
    "competitor_check",
    f"""
    SELECT doc_id,
        CASE WHEN hit THEN {sql.joined(f"list_filter({sql.sentences('text')}, lambda s: NOT {sql.matches('s', sql.bounded(tx.any_of(BANNED)))})")}
            ELSE text END AS sanitized,
        {sql.yes_no('hit')},
        array_to_string(list_filter([{sql.listed(sorted(BANNED))}],
            lambda t: regexp_matches(text, '\\b' || t || '\\b')), '|') AS found
    FROM (SELECT *, {sql.matches('text', sql.bounded(tx.any_of(BANNED)))} AS hit FROM documents)
    """,
)
def competitor_check(spark, folder):
    done = verdicts(
        documents(spark, folder), ["doc_id"], "text", rules.competitor_check(BANNED), "found"
    )
    return done.withColumn("found", F.array_join("found", "|"))


@query(
    "ban_competitors",
    f"""
    SELECT doc_id,
        CASE WHEN risk >= 0.3 THEN {sql.replaced('text', f'(?i){sql.bounded(tx.any_of(BANNED))}', '[REDACTED]')}
            ELSE text END AS sanitized,
        {sql.scored('risk', 0.3)}
    FROM (
        SELECT *, CASE WHEN {sql.matches('text', sql.bounded(tx.any_of(BANNED)))} THEN 1.0::DOUBLE
            WHEN {sql.matches('text', f'(?i){sql.bounded(tx.any_of(BANNED))}')} THEN 0.4::DOUBLE
            ELSE 0.0::DOUBLE END AS risk
        FROM documents
    )
    """,
)
def ban_competitors(spark, folder):
    rule = rules.ban_competitors(BANNED, threshold=0.3)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)


ENDS = ["on.", "en.", "he."]


@query(
    "ends_with",
    f"""
    SELECT doc_id, CASE WHEN ok THEN text ELSE text || {sql.quoted(ENDS[0])} END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (SELECT doc_id, text, {' OR '.join(f"ends_with(text, '{e}')" for e in ENDS)} AS ok FROM documents)
    """,
)
def ends_with(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", rules.ends_with(ENDS))


# --- choices, ranges, formats -----------------------------------------------

STATES = ["F", "O"]


@query(
    "valid_choices",
    f"""
    SELECT o_orderkey, CASE WHEN ok THEN o_orderstatus END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (SELECT *, o_orderstatus IN ({sql.listed(STATES)}) AS ok FROM orders)
    """,
)
def valid_choices(spark, folder):
    df = table(spark, folder, "orders")
    return verdicts(df, ["o_orderkey"], "o_orderstatus", rules.valid_choices(STATES))


CHOICE_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey {word} (SELECT p_partkey FROM part WHERE p_size > 25)
"""


@query("valid_choices_semi", CHOICE_SQL.format(word="IN"))
def valid_choices_semi(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    allowed = table(spark, folder, "part").filter("p_size > 25").select("p_partkey")
    return rules.choices_from_table(lines, "l_partkey", allowed, "p_partkey")[0]


@query("valid_choices_anti", CHOICE_SQL.format(word="NOT IN"))
def valid_choices_anti(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    allowed = table(spark, folder, "part").filter("p_size > 25").select("p_partkey")
    return rules.choices_from_table(lines, "l_partkey", allowed, "p_partkey")[1]


@query(
    "valid_range_json",
    f"""
    SELECT event_id, CASE WHEN ok THEN props END AS sanitized, {sql.yes_no('NOT ok')}, k
    FROM (
        SELECT *, k BETWEEN 0 AND 50 AS ok
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
    )
    """,
)
def valid_range_json(spark, folder):
    record = T.StructType([T.StructField("k", T.IntegerType())])
    rule = rules.valid_range_json(record, "k", 0, 50)
    return verdicts(table(spark, folder, "events"), ["event_id"], "props", rule, "k")


@query(
    "valid_range_col",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS sanitized, {sql.yes_no('NOT (l_quantity BETWEEN 5 AND 25)')}
    FROM lineitem
    """,
)
def valid_range_col(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return verdicts(table(spark, folder, "lineitem"), keys, "l_quantity", rules.valid_range(5, 25))


MAYBE_JSON = """
    CASE event_type WHEN 'error' THEN replace(props, '}', ',}') WHEN 'click' THEN concat(props, ' x')
        WHEN 'view' THEN concat('[', props, ', null, "', event_type, '"]') ELSE props END
"""


@query(
    "valid_json",
    f"""
    SELECT event_id, CASE WHEN ok THEN x END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (
        SELECT event_id, x, json_valid(x) AND NOT regexp_matches(x, ',\\s*[}}\\]]') AS ok
        FROM (SELECT event_id, {MAYBE_JSON} AS x FROM events)
    )
    """,
)
def valid_json(spark, folder):
    df = spread(table(spark, folder, "events").selectExpr("event_id", f"{MAYBE_JSON} AS x"))
    return verdicts(df, ["event_id"], "x", rules.valid_json())


SOURCE = """
    concat('def size_of(x):', chr(10), CASE p_type WHEN 'PROMO' THEN '' ELSE '    ' END, 'return ',
        p_size, CASE WHEN p_size < 5 THEN ' +' ELSE '' END)
"""


@query(
    "valid_python",
    f"""
    SELECT p_partkey, CASE WHEN ok THEN x END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (SELECT p_partkey, {SOURCE} AS x, p_type <> 'PROMO' AND p_size >= 5 AS ok FROM part)
    """,
)
def valid_python(spark, folder):
    df = spread(table(spark, folder, "part").selectExpr("p_partkey", f"{SOURCE} AS x"))
    return verdicts(df, ["p_partkey"], "x", rules.valid_python())


@query(
    "valid_url",
    f"""
    SELECT page_id, CASE WHEN ok THEN x END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (
        SELECT page_id, x, regexp_full_match(x, 'https?://[^\\s/?#]+([/?#]\\S*)?') AS ok
        FROM (SELECT page_id, replace(url, '?', ' ?') AS x FROM pages)
    )
    """,
)
def valid_url(spark, folder):
    df = table(spark, folder, "pages").selectExpr("page_id", "replace(url, '?', ' ?') AS x")
    return verdicts(df, ["page_id"], "x", rules.valid_url())


TAG = r"<\s*/?\s*[a-z!][^>]*>"
HANDLER = r"\son[a-z]+\s*="
BODIES = r"(?is)<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>"


@query(
    "web_sanitize",
    f"""
    SELECT page_id,
        CASE WHEN bad THEN {sql.replaced(sql.replaced(sql.replaced(sql.replaced('html', BODIES, ''), f'(?is){TAG}', ''), '(?i)<[</ \\t\\n\\r\\f]*([a-z!])', chr(92) + '1'), f'(?i)javascript:|{HANDLER}', '[REDACTED]')}
            ELSE html END AS sanitized,
        {sql.yes_no('bad')}
    FROM (SELECT *, {sql.matches('html', f'(?is)(?:{TAG})|javascript:|(?:{HANDLER})')} AS bad FROM pages)
    """,
)
def web_sanitize(spark, folder):
    df = text_table(spark, folder, "pages", "page_id", "html")
    return verdicts(df, ["page_id"], "html", rules.web_sanitization())


OFFER = """
    concat(p_name, ' now at ', CASE p_type WHEN 'PROMO' THEN '€' WHEN 'ECONOMY' THEN '£'
        WHEN 'LARGE' THEN 'JPY ' WHEN 'MEDIUM' THEN 'number ' ELSE '$' END,
        cast(cast(p_retailprice AS decimal(12, 2)) AS string), '!')
"""
EXPECTED = "CASE WHEN p_size <= 20 THEN 'USD' WHEN p_size <= 35 THEN 'EUR' END"
PRICE = {code: rules.price_pattern(code) for code in wl.CURRENCIES}


@query(
    "quotes_price",
    f"""
    SELECT p_partkey, CASE WHEN NOT bad THEN x END AS sanitized, {sql.yes_no('bad')}, quoted
    FROM (
        SELECT p_partkey, x, quoted, CASE WHEN expected IS NULL THEN quoted <> ''
            ELSE contains(quoted, expected) END AS bad
        FROM (
            SELECT p_partkey, x, expected, array_to_string(list_filter([
                {', '.join(f"CASE WHEN {sql.matches('x', PRICE[c])} THEN '{c}' END" for c in PRICE)}
            ], lambda c: c IS NOT NULL), '|') AS quoted
            FROM (SELECT p_partkey, {OFFER} AS x, {EXPECTED} AS expected FROM part)
        )
    )
    """,
)
def quotes_price(spark, folder):
    df = table(spark, folder, "part").selectExpr(
        "p_partkey", f"{OFFER} AS x", f"{EXPECTED} AS expected"
    )
    done = verdicts(df, ["p_partkey"], "x", rules.quotes_price(F.col("expected")), "quoted")
    return done.withColumn("quoted", F.array_join("quoted", "|"))


SPELLED = "regexp_extract_all(text, '[A-Za-z]+(?:''[A-Za-z]+)?')"


@query(
    "reading_level",
    f"""
    SELECT doc_id, CASE WHEN ok THEN text END AS sanitized, {sql.yes_no('NOT ok')}, grade
    FROM (
        SELECT *, coalesce(grade BETWEEN 4 AND 8, false) AS ok
        FROM (
            SELECT doc_id, text, round(0.39::DOUBLE * len(w) / s + 11.8::DOUBLE * (list_sum(
                list_transform(w, lambda v: greatest(1, len(regexp_extract_all(
                    regexp_replace(lower(v), 'e$', ''), '[aeiouy]+'))))) / nullif(len(w), 0))
                - 15.59::DOUBLE, 6) AS grade
            FROM (
                SELECT doc_id, text, {SPELLED} AS w,
                    greatest(1, {sql.hits('text', '[^.!?]+[.!?]+')}) AS s
                FROM documents
            )
        )
    )
    """,
)
def reading_level(spark, folder):
    rule = rules.reading_level(4, 8)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule, "grade")


# --- hidden text and length --------------------------------------------------

TAGS_IN = "".join(chr(code) for code in range(0xA0, 0x100))
ASCII = "".join(chr(code) for code in range(0x20, 0x7F)).replace("'", "''")
SHOWN = "chr(10) || chr(13) || chr(9) || '" + ASCII + TAGS_IN + "'"
HIDDEN = "'" + "".join(
    chr(0xE0000 + ord(letter)) for letter in "\n\r\t" + ASCII.replace("''", "'") + TAGS_IN
) + "'"
INVISIBLE = r"[\p{Cf}\p{Co}\x{E0002}-\x{E001F}\x{E0080}-\x{E00FF}]"
TURNS = """
    SELECT conv_id, turn, CASE role WHEN 'user' THEN text || translate(text, {shown}, {hidden})
        ELSE text END AS x
    FROM conversations
""".format(shown=SHOWN, hidden=HIDDEN)


def turns_with_hidden_text(spark, folder):
    turns = text_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    hidden = F.concat("text", rules.to_tag_text(F.col("text")))
    return turns.select(
        "conv_id", "turn", F.when(F.col("role") == "user", hidden).otherwise(F.col("text")).alias("x")
    )


@query(
    "invisible_text",
    f"""
    SELECT conv_id, turn, {sql.replaced('x', INVISIBLE, '')} AS sanitized,
        {sql.yes_no(sql.matches('x', INVISIBLE))}
    FROM ({TURNS})
    """,
)
def invisible_text(spark, folder):
    df = turns_with_hidden_text(spark, folder)
    return verdicts(df, ["conv_id", "turn"], "x", rules.invisible_text())


@query(
    "reveal_tag_text",
    f"""
    SELECT conv_id, turn, CASE role WHEN 'user' THEN text ELSE '' END AS revealed
    FROM conversations
    """,
)
def reveal_tag_text(spark, folder):
    df = turns_with_hidden_text(spark, folder)
    return df.select("conv_id", "turn", rules.reveal_tag_text(F.col("x")).alias("revealed"))


LIMIT = 100
LIMIT_TOKENS = r"[ \t\n\r\f]*(?:[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\f])"


@query(
    "token_limit",
    f"""
    SELECT doc_id, CASE WHEN n_tokens > {LIMIT} THEN array_to_string(t[1:{LIMIT}], '') ELSE text END AS sanitized,
        {sql.yes_no(f'n_tokens > {LIMIT}')}, n_tokens
    FROM (
        SELECT *, len(t) AS n_tokens
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{LIMIT_TOKENS}') AS t FROM documents)
    )
    """,
)
def token_limit(spark, folder):
    rule = rules.token_limit(LIMIT)
    done = verdicts(documents(spark, folder), ["doc_id"], "text", rule, "n_tokens")
    return done.withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query(
    "token_chunk",
    f"""
    SELECT doc_id, CAST(i AS INTEGER) AS pos, array_to_string(t[i * {LIMIT} + 1 : (i + 1) * {LIMIT}], '') AS chunk
    FROM (
        SELECT doc_id, t, unnest(range(CAST(ceil(len(t) / {LIMIT}) AS BIGINT))) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{LIMIT_TOKENS}') AS t FROM documents)
    )
    """,
)
def token_chunk(spark, folder):
    df = documents(spark, folder)
    return df.select(
        "doc_id", F.posexplode(rules.token_chunks(F.col("text"), LIMIT)).alias("pos", "chunk")
    )


# --- personal data ------------------------------------------------------------

PII = pii.rules_for("pii")


@query(
    "pii_redact",
    f"""
    SELECT doc_id, {sql.pii_masked('text', PII)} AS sanitized, {sql.yes_no(sql.pii_found('text', PII))}
    FROM documents
    """,
)
def pii_redact(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", pii.pii_filter("pii"))


ALL_PII = wl.PII_RULES


@query(
    "pii_entity_counts",
    f"""
    SELECT lang, entity, CAST(sum(n) AS BIGINT) AS n_hits
    FROM (
        SELECT lang, unnest([{sql.listed([r.entity for r in ALL_PII])}]) AS entity,
            unnest([{', '.join(sql.hits('t', f'<{r.entity}>') for r in ALL_PII)}]) AS n
        FROM (SELECT lang, {sql.pii_masked('text', ALL_PII)} AS t FROM documents)
    )
    GROUP BY lang, entity
    """,
)
def pii_entity_counts(spark, folder):
    return pii.count_pii(documents(spark, folder, "lang"), "text", ALL_PII, ["lang"])


ALLOWED = ["127.0.0.1", "192.168.0.1"]
HIDDEN_NAMES = ["worthless", "pathetic"]


def _vault_sql() -> str:
    """Mask rule by rule, keeping the values of each in order, then fill the masks again."""
    steps = [("CUSTOM", sql.bounded(tx.any_of(HIDDEN_NAMES)), 0, "<CUSTOM>")]
    for rule in PII:
        mark = rf"{chr(92) + '1' if rule.lead else ''}<{rule.entity}>"
        steps.append((rule.entity, sql.pii_pattern(rule), 2 if rule.lead else 0, mark))
    ctes = ["s0 AS (SELECT doc_id, text, text AS t0 FROM documents)"]
    for i, (_, pattern, group, mark) in enumerate(steps):
        values = f"regexp_extract_all(t{i}, {sql.quoted(pattern)}, {group})"
        ctes.append(
            f"s{i + 1} AS (SELECT *, {values} AS a{i}, list_filter({values}, lambda v, p: list_position({values}, v)"
            f" = p AND v NOT IN ({sql.listed(ALLOWED)})) AS v{i},"
            f" {sql.replaced(f't{i}', pattern, mark)} AS t{i + 1} FROM s{i})"
        )
    ctes.append(f"f0 AS (SELECT *, t{len(steps)} AS b0 FROM s{len(steps)})")
    for turn, (i, (entity, *_)) in enumerate(reversed(list(enumerate(steps)))):
        put = (
            f"coalesce(CASE WHEN list_position(v{i}, a{i}[p]) > 0 THEN '[REDACTED_{entity}_'"
            f" || list_position(v{i}, a{i}[p]) || ']' ELSE a{i}[p] END, '')"
        )
        pieces = f"string_split(b{turn}, '<{entity}>')"
        ctes.append(
            f"f{turn + 1} AS (SELECT *, CASE WHEN len(a{i}) > 0 THEN array_to_string(list_transform({pieces},"
            f" lambda x, p: x || {put}), '') ELSE b{turn} END AS b{turn + 1} FROM f{turn})"
        )
    ctes.append(f"filled AS (SELECT doc_id, text, b{len(steps)} AS sanitized FROM f{len(steps)})")
    entries = " UNION ALL ".join(
        f"SELECT doc_id, '{entity}' AS entity_type, unnest(v{i}) AS value,"
        f" CAST(unnest(range(1, len(v{i}) + 1)) AS INTEGER) AS idx FROM s{len(steps)}"
        for i, (entity, *_) in enumerate(steps)
    )
    ctes.append(
        "vault AS (SELECT *, '[REDACTED_' || entity_type || '_' || idx || ']' AS placeholder"
        f" FROM ({entries}))"
    )
    return "WITH " + ",\n".join(ctes)


VAULT = _vault_sql()


def anonymized(spark, folder):
    return pii.anonymize(
        documents(spark, folder), "text", "pii", allowed_names=ALLOWED, hidden_names=HIDDEN_NAMES
    )


@query("anonymize_vault", f"{VAULT} SELECT doc_id, entity_type, idx, value, placeholder FROM vault")
def anonymize_vault(spark, folder):
    return pii.vault_table(anonymized(spark, folder), "doc_id")


@query(
    "anonymize_text",
    f"""{VAULT}
    SELECT doc_id, sanitized, {sql.yes_no('doc_id IN (SELECT doc_id FROM vault)')} FROM filled
    """,
)
def anonymize_text(spark, folder):
    return anonymized(spark, folder).select(
        "doc_id", "scan.sanitized", "scan.is_valid", "scan.risk_score"
    )


@query(
    "anonymize_restore",
    "SELECT doc_id, text AS restored FROM documents",
)
def anonymize_restore(spark, folder):
    done = anonymized(spark, folder).withColumn("sanitized", F.col("scan.sanitized"))
    return done.select("doc_id", pii.restore("sanitized").alias("restored"))


# One vault for all documents: values numbered by kind, local placeholders exchanged through marks
# that no text holds.
CORPUS_VAULT = f"""{VAULT},
    numbered AS (
        SELECT entity_type, value, row_number() OVER (PARTITION BY entity_type ORDER BY value) AS idx
        FROM (SELECT DISTINCT entity_type, value FROM vault)),
    exchanged AS (
        SELECT v.doc_id, list(v.placeholder || chr(1) || chr(2) || v.entity_type || '_' || n.idx || chr(3)) AS e
        FROM vault v JOIN numbered n USING (entity_type, value) GROUP BY v.doc_id)"""


def corpus_vault(spark, folder):
    docs = documents(spark, folder)
    return vault.anonymize_corpus(docs, "doc_id", "text", allowed_names=ALLOWED, hidden_names=HIDDEN_NAMES)


@query(
    "vault_corpus",
    f"""{CORPUS_VAULT}
    SELECT entity_type, idx, value, '[REDACTED_' || entity_type || '_' || idx || ']' AS placeholder FROM numbered""",
)
def vault_corpus(spark, folder):
    return corpus_vault(spark, folder).vault


@query(
    "vault_corpus_text",
    f"""{CORPUS_VAULT}
    SELECT doc_id, CASE WHEN e IS NULL THEN sanitized ELSE replace(replace(list_reduce(e, lambda done, x:
        replace(done, split_part(x, chr(1), 1), split_part(x, chr(1), 2)), sanitized), chr(2), '[REDACTED_'), chr(3), ']')
        END AS sanitized, e IS NULL AS is_valid
    FROM filled LEFT JOIN exchanged USING (doc_id)""",
)
def vault_corpus_text(spark, folder):
    return corpus_vault(spark, folder).texts


@query("vault_corpus_restore", "SELECT doc_id, text AS restored FROM documents")
def vault_corpus_restore(spark, folder):
    done = corpus_vault(spark, folder)
    back = vault.restore_corpus(done.texts, done.vault, "doc_id")
    return back.select("doc_id", F.col("sanitized").alias("restored"))


SENSITIVE = pii.rules_for(["PERSON", "EMAIL", "IP", "PHONE", "CREDIT_CARD"])


@query(
    "sensitive_output",
    f"""
    SELECT conv_id, turn, {sql.pii_masked('output', SENSITIVE)} AS sanitized,
        {sql.yes_no(sql.pii_found('output', SENSITIVE))}
    FROM ({sql.PAIRS})
    """,
)
def sensitive_output(spark, folder):
    rule = pii.pii_filter(["PERSON", "EMAIL", "IP", "PHONE", "CREDIT_CARD"])
    return verdicts(pairs(spark, folder), ["conv_id", "turn"], "output", rule)


# --- scored categories ----------------------------------------------------------


def by_sentence_sql(lexicon: Sequence[Entry], threshold: float) -> str:
    def score(x: str) -> str:
        return sql.lexicon_score(x, lexicon)

    return f"""
    SELECT doc_id, CASE WHEN risk < {threshold} THEN text
        ELSE {sql.joined(f"list_filter(s, lambda u: {score('u')} < {threshold})")} END AS sanitized,
        {sql.scored('risk', threshold)}
    FROM (
        SELECT *, coalesce(list_max(list_transform(s, lambda u: {score('u')})), 0::DOUBLE) AS risk
        FROM (SELECT doc_id, text, {sql.sentences('text')} AS s FROM documents)
    )
    """


def full_sql(source: str, keys: str, text: str, risk: str, threshold: float) -> str:
    return f"""
    SELECT {keys}, CASE WHEN risk < {threshold} THEN x END AS sanitized, {sql.scored('risk', threshold)}
    FROM (SELECT {keys}, {text} AS x, {risk} AS risk FROM {source})
    """


def words_and(lexicon: Sequence[Entry], *more: Entry) -> list[Entry]:
    return [*lexicon, *more]


@query("toxicity", by_sentence_sql(wl.TOXIC, 0.5))
def toxicity(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", scored.toxicity())


@query(
    "toxicity_eval",
    f"""
    SELECT toxic, is_valid, count(*) AS n
    FROM ({by_sentence_sql(wl.TOXIC, 0.5)}) JOIN labels USING (doc_id)
    GROUP BY toxic, is_valid
    """,
)
def toxicity_eval(spark, folder):
    done = scan(documents(spark, folder), "text", scored.toxicity(), out=["scan"])
    judged = done.select("doc_id", "scan.is_valid")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return judged.join(labels, "doc_id").groupBy("toxic", "is_valid").agg(F.count(F.lit(1)).alias("n"))


NSFW = words_and(wl.NSFW, Entry("disgusting", 0.9), Entry("trash", 0.5))


@query("nsfw", by_sentence_sql(NSFW, 0.8))
def nsfw(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", scored.nsfw(lexicon=NSFW))


PROFANE = [*wl.PROFANITY, "idiot", "moron", "scum", "worthless"]


def _masked_words(x: str) -> str:
    """Mask word by word; the letters around a hit are given back."""
    for _ in range(2):
        for term in sorted(PROFANE, key=len, reverse=True):
            x = sql.replaced(
                x, rf"(?i)(^|[^\p{{L}}\p{{N}}]){term}($|[^\p{{L}}\p{{N}}])", rf"\1{'*' * len(term)}\2"
            )
    return x


@query(
    "profanity",
    f"""
    SELECT doc_id, {_masked_words('text')} AS sanitized, {sql.yes_no(sql.word_hits('text', PROFANE) + ' > 0')}
    FROM documents
    """,
)
def profanity(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", scored.profanity(PROFANE))


TOPIC_WORDS = {**wl.TOPICS, "waste": [Entry("trash", 0.4), Entry("scum", 0.7)]}


@query(
    "ban_topics",
    full_sql(
        "documents",
        "doc_id",
        "text",
        f"greatest({sql.lexicon_score('text', TOPIC_WORDS['violence'])}, {sql.lexicon_score('text', TOPIC_WORDS['waste'])})",
        0.5,
    ),
)
def ban_topics(spark, folder):
    rule = scored.ban_topics(["violence", "waste"], lexicons=TOPIC_WORDS)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)


BIAS = words_and(wl.BIAS, Entry(r"for the", 0.3, phrase=True), Entry("of that", 0.4, phrase=True))


@query(
    "bias",
    full_sql(f"({sql.PAIRS})", "conv_id, turn", "output", sql.lexicon_score("output", BIAS), 0.5),
)
def bias(spark, folder):
    return verdicts(pairs(spark, folder), ["conv_id", "turn"], "output", scored.bias(lexicon=BIAS))


INJECTION = words_and(
    wl.INJECTION, Entry(r"(?:with|from) [^\n]{0,40}(?:this|that)", 0.3, phrase=True), Entry("when", 0.2)
)


@query(
    "prompt_injection",
    full_sql(f"({sql.PAIRS})", "conv_id, turn", "prompt", sql.lexicon_score("prompt", INJECTION), 0.5),
)
def prompt_injection(spark, folder):
    rule = scored.prompt_injection(lexicon=INJECTION)
    return verdicts(pairs(spark, folder), ["conv_id", "turn"], "prompt", rule)


REFUSAL = words_and(wl.REFUSAL, Entry("not", 0.3), Entry("nicht", 0.3), Entry("pas", 0.2))


@query(
    "no_refusal",
    full_sql(f"({sql.PAIRS})", "conv_id, turn", "output", sql.lexicon_score("output", REFUSAL), 0.5),
)
def no_refusal(spark, folder):
    rule = scored.no_refusal(lexicon=REFUSAL)
    return verdicts(pairs(spark, folder), ["conv_id", "turn"], "output", rule)


@query(
    "refusal_report",
    f"""
    SELECT conv_id, count(*) AS n_rows, count(*) FILTER (risk >= 0.5) AS n_violations,
        round(avg(risk), 6) AS avg_risk, max(risk) AS max_risk
    FROM (SELECT conv_id, {sql.lexicon_score('output', REFUSAL)} AS risk FROM ({sql.PAIRS}))
    GROUP BY conv_id
    """,
)
def refusal_report(spark, folder):
    rule = scored.no_refusal(lexicon=REFUSAL)
    return violation_report(scan(pairs(spark, folder), "output", rule, out=["scan"]), ["conv_id"])


MANIPULATION = words_and(wl.MANIPULATION, Entry("und die", 0.6, phrase=True), Entry("la de", 0.5, phrase=True))


@query(
    "unusual_prompt",
    full_sql(
        f"({sql.PAIRS})", "conv_id, turn", "prompt", sql.lexicon_score("prompt", MANIPULATION), 0.5
    ),
)
def unusual_prompt(spark, folder):
    rule = scored.unusual_prompt(lexicon=MANIPULATION)
    return verdicts(pairs(spark, folder), ["conv_id", "turn"], "prompt", rule)


PLUS = [*wl.POSITIVE, "with", "mit", "avec", "con"]
MINUS = [*wl.NEGATIVE, "not", "nicht", "pas", "that"]
BALANCE = f"""
    coalesce(({sql.word_hits('text', PLUS)} - {sql.word_hits('text', MINUS)})
        / nullif({sql.word_hits('text', PLUS)} + {sql.word_hits('text', MINUS)}, 0), 0)
"""


@query(
    "sentiment",
    f"""
    SELECT doc_id, CASE WHEN b >= 0 THEN text END AS sanitized, b >= 0 AS is_valid,
        round(greatest(0::DOUBLE, -b), 6) AS risk_score
    FROM (SELECT doc_id, text, {BALANCE} AS b FROM documents)
    """,
)
def sentiment(spark, folder):
    rule = scored.sentiment(0.0, PLUS, MINUS)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule)


WANTED = "CASE lang WHEN 'en' THEN 'positive' WHEN 'fr' THEN 'negative' ELSE 'neutral' END"


@query(
    "financial_tone",
    f"""
    SELECT doc_id, CASE WHEN tone = wanted THEN text END AS sanitized, {sql.yes_no('tone <> wanted')}, tone
    FROM (
        SELECT doc_id, text, {WANTED} AS wanted,
            CASE WHEN b > 0 THEN 'positive' WHEN b < 0 THEN 'negative' ELSE 'neutral' END AS tone
        FROM (SELECT *, {BALANCE} AS b FROM documents)
    )
    """,
)
def financial_tone(spark, folder):
    rule = scored.financial_tone(F.expr(WANTED), PLUS, MINUS)
    return verdicts(documents(spark, folder, "lang"), ["doc_id"], "text", rule, "tone")


CODE = {**wl.CODE_LINES, "Table": [r"^[^|]*\|[^|]*\|"], "Config": [r"[a-z]+ = \"", "^#"]}


def _line_share(name: str) -> str:
    anything = "|".join(f"(?:{p})" for p in CODE[name])
    return f"coalesce(round(len(list_filter(l, lambda s: {sql.matches('s', anything)})) / nullif(len(l), 0), 6), 0)::DOUBLE"


@query(
    "code_detect",
    f"""
    SELECT doc_id, CASE WHEN NOT bad THEN text END AS sanitized, NOT bad AS is_valid,
        CASE WHEN best.name IN ('Python', 'Table') THEN best.score ELSE 0.0::DOUBLE END AS risk_score,
        CASE WHEN best.score >= 0.5 THEN best.name END AS language
    FROM (
        SELECT *, best.name IN ('Python', 'Table') AND best.score >= 0.5 AS bad
        FROM (
            SELECT doc_id, text, list_max([{', '.join(f"struct_pack(score := {_line_share(n)}, name := '{n}')" for n in sorted(CODE))}]) AS best
            FROM (
                SELECT doc_id, text, list_filter(string_split(text, chr(10)),
                    lambda s: regexp_matches(s, '[^ \\t\\n\\r\\f]')) AS l
                FROM documents
            )
        )
    )
    """,
)
def code_detect(spark, folder):
    rule = scored.code(["Python", "Table"], patterns=CODE)
    return verdicts(documents(spark, folder), ["doc_id"], "text", rule, "language")


LEXICON_SQL = " UNION ALL ".join(
    f"SELECT '{category}' AS category, '{e.term}' AS term, {e.weight}::DOUBLE AS weight"
    for category, entries in {"toxic": wl.TOXIC, "cue": [Entry(c, 0.1) for c in CUES]}.items()
    for e in entries
)


@query(
    "lexicon_scores",
    f"""
    WITH lexicon AS ({LEXICON_SQL}),
    hits AS (
        SELECT doc_id, category, sum(weight) AS total
        FROM (SELECT doc_id, unnest({sql.words('text')}) AS term FROM documents) JOIN lexicon USING (term)
        GROUP BY doc_id, category
    )
    SELECT doc_id, category, {sql.scored('round(least(1::DOUBLE, coalesce(total, 0)), 6)', 0.5)}
    FROM documents CROSS JOIN (SELECT DISTINCT category FROM lexicon) LEFT JOIN hits USING (doc_id, category)
    """,
)
def lexicon_scores(spark, folder):
    entries = [("toxic", e.term, e.weight) for e in wl.TOXIC] + [("cue", c, 0.1) for c in CUES]
    lexicon = spark.createDataFrame(entries, "category string, term string, weight double")
    return scored.lexicon_scores(documents(spark, folder), "doc_id", "text", lexicon)


# --- language ----------------------------------------------------------------------


@query(
    "correct_language",
    f"""
    SELECT doc_id, CASE WHEN ok THEN text END AS sanitized, {sql.yes_no('NOT ok')},
        f.lang AS found_lang, f.confidence AS confidence
    FROM (
        SELECT *, f.lang = 'en' AND f.confidence >= 0.75 AS ok
        FROM (SELECT doc_id, text, {sql.language('text')} AS f FROM documents)
    )
    """,
)
def correct_language(spark, folder):
    rule = lang.correct_language("en", 0.75)
    done = verdicts(documents(spark, folder), ["doc_id"], "text", rule, "found")
    return done.select(
        "doc_id", "sanitized", "is_valid", "risk_score",
        F.col("found.lang").alias("found_lang"), "found.confidence",
    )


@query(
    "language_eval",
    f"""
    SELECT lang, f.lang AS found_lang, count(*) AS n, round(avg(f.confidence), 6) AS avg_confidence
    FROM (SELECT lang, {sql.language('text')} AS f FROM documents)
    GROUP BY lang, f.lang
    """,
)
def language_eval(spark, folder):
    df = documents(spark, folder, "lang").withColumn("f", lang.detect_language(F.col("text")))
    return df.groupBy("lang", F.col("f.lang").alias("found_lang")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("f.confidence"), 6).alias("avg_confidence")
    )


@query(
    "language_allowed",
    f"""
    SELECT doc_id, CASE WHEN ok THEN text END AS sanitized, {sql.yes_no('NOT ok')}
    FROM (SELECT doc_id, text, ({sql.language('text')}).lang IN ('en', 'de') AS ok FROM documents)
    """,
)
def language_allowed(spark, folder):
    return verdicts(documents(spark, folder), ["doc_id"], "text", lang.language(["en", "de"]))


@query(
    "language_same",
    f"""
    SELECT conv_id, turn, {sql.yes_no("p <> o OR p = 'und'")}, p AS prompt_lang, o AS output_lang
    FROM (
        SELECT conv_id, turn, ({sql.language('prompt')}).lang AS p, ({sql.language('output')}).lang AS o
        FROM ({sql.PAIRS})
    )
    """,
)
def language_same(spark, folder):
    rule = lang.language_same(F.col("prompt"))
    done = verdicts(
        pairs(spark, folder), ["conv_id", "turn"], "output", rule, "prompt_lang", "output_lang"
    )
    return done.drop("sanitized")


# --- composition and reports --------------------------------------------------------

CHAIN = [
    rules.ban_substrings(BANNED, match_type="word", case_sensitive=True),
    pii.pii_filter("pii"),
    scored.toxicity(),
    rules.token_limit(1000),
]
CHAIN_SQL = f"""
    WITH a AS (
        SELECT *, {sql.matches('text', sql.bounded(tx.any_of(BANNED)))} AS bad_a,
            {sql.replaced('text', sql.bounded(tx.any_of(BANNED)), '[REDACTED]')} AS ta
        FROM documents
    ),
    b AS (SELECT *, {sql.pii_found('ta', PII)} AS bad_b, {sql.pii_masked('ta', PII)} AS tb FROM a),
    c AS (
        SELECT *, coalesce(list_max(list_transform({sql.sentences('tb')},
            lambda u: {sql.lexicon_score('u', wl.TOXIC)})), 0::DOUBLE) AS risk_c
        FROM b
    ),
    d AS (
        SELECT *, CASE WHEN risk_c < 0.5 THEN tb ELSE {sql.joined(f"list_filter({sql.sentences('tb')}, lambda u: {sql.lexicon_score('u', wl.TOXIC)} < 0.5)")} END AS tc
        FROM c
    ),
    e AS (SELECT *, regexp_extract_all(tc, '{LIMIT_TOKENS}') AS toks FROM d),
    chained AS (
        SELECT doc_id, source, lang,
            CASE WHEN len(toks) > 1000 THEN array_to_string(toks[1:1000], '') ELSE tc END AS sanitized,
            NOT bad_a AND NOT bad_b AND risk_c < 0.5 AND len(toks) <= 1000 AS is_valid,
            greatest(CASE WHEN bad_a OR bad_b OR len(toks) > 1000 THEN 1::DOUBLE ELSE 0::DOUBLE END, risk_c)
                AS risk_score,
            array_to_string(list_filter([CASE WHEN bad_a THEN 'ban_substrings' END,
                CASE WHEN bad_b THEN 'pii_filter' END, CASE WHEN risk_c >= 0.5 THEN 'toxicity' END,
                CASE WHEN len(toks) > 1000 THEN 'token_limit' END], lambda f: f IS NOT NULL), '|') AS failed
        FROM e
    )
"""


def chained(spark, folder):
    return compose(documents(spark, folder, "source", "lang"), "text", CHAIN)


@query(
    "guard_compose", f"{CHAIN_SQL} SELECT doc_id, sanitized, is_valid, risk_score, failed FROM chained"
)
def guard_compose(spark, folder):
    return chained(spark, folder).select(
        "doc_id",
        "scan.sanitized",
        "scan.is_valid",
        "scan.risk_score",
        F.array_join("scan.failed", "|").alias("failed"),
    )


@query(
    "guard_quarantine",
    f"""{CHAIN_SQL}
    SELECT doc_id, CASE WHEN is_valid THEN 'valid' ELSE 'quarantine' END AS split, failed FROM chained
    """,
)
def guard_quarantine(spark, folder):
    valid, quarantine = split_valid(chained(spark, folder), "scan")
    failed = F.array_join("scan.failed", "|").alias("failed")
    return valid.select("doc_id", F.lit("valid").alias("split"), failed).union(
        quarantine.select("doc_id", F.lit("quarantine").alias("split"), failed)
    )


REPORT_SQL = """
    SELECT source, lang, count(*) AS n_rows, count(*) FILTER (NOT is_valid) AS n_violations,
        round(avg(risk_score), 6) AS avg_risk, max(risk_score) AS max_risk
    FROM chained GROUP BY {by}
"""


@query("guard_report", CHAIN_SQL + REPORT_SQL.format(by="source, lang"))
def guard_report(spark, folder):
    return violation_report(chained(spark, folder), ["source", "lang"])


@query("guard_report_rollup", CHAIN_SQL + REPORT_SQL.format(by="ROLLUP (source, lang)"))
def guard_report_rollup(spark, folder):
    return violation_rollup(chained(spark, folder), ["source", "lang"])
