"""Personal data: redaction, counts, and numbered placeholders with a vault.

The rules run in a fixed order, and each sees the text that the rules before it
left, so a number inside an e-mail address is never found a second time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.functions.wordlists import PII_ALIASES, PII_GROUPS, PII_RULES, PiiRule
from textguard.operators.rule import Expression, Rule, flag

CUSTOM, LITERAL, MARKS = "CUSTOM", "LITERAL", "MARKS"
PLACEHOLDER = r"\[REDACTED_[A-Z_]+_[0-9]+\]"
FIRST_MARK = 0xF0000
NUMBER_EDGE = "(?:(?<![A-Za-z0-9_])(?=[0-9])|(?<=[0-9])(?![A-Za-z0-9_]))"
Gazetteer = Mapping[str, Sequence[str]]


def rules_for(entities: str | Sequence[str], gazetteer: Gazetteer | None = None) -> list[PiiRule]:
    """The rules of a named group or a list of entities, in their fixed order.

    A gazetteer adds known values (places, names) of an entity as further rules. A list
    may use the aliases of other tools; an entity without a rule or a gazetteer raises, since
    it would pass unseen.
    """
    if isinstance(entities, str):
        wanted = PII_GROUPS[entities]
    else:
        wanted = [PII_ALIASES.get(name, name) for name in entities]
        missing = set(wanted) - {rule.entity for rule in PII_RULES} - set(gazetteer or {})
        if missing:
            raise ValueError(f"no rule or gazetteer for {sorted(missing)}")
    known = [
        PiiRule(name, tx.any_of(values), needs=tx.any_of(values))
        for name, values in (gazetteer or {}).items()
    ]
    return [rule for rule in [*PII_RULES, *known] if rule.entity in wanted]


def _pattern(rule: PiiRule) -> str:
    body = rule.pattern.replace("{edge}", NUMBER_EDGE)
    if rule.lead:
        return f"({rule.lead})({body})"
    return tx.ascii_word(body) if rule.edges else f"(?:{body})"


def _masked(text: Column, rule: PiiRule) -> Column:
    kept = "$1" if rule.lead else ""
    return F.regexp_replace(text, _pattern(rule), f"{kept}<{rule.entity}>")


def _values(text: Column, rule: PiiRule) -> Column:
    return tx.extract(text, _pattern(rule), 2 if rule.lead else 0)


def _by_need(rules: Sequence[PiiRule]) -> list[tuple[str, list[PiiRule]]]:
    """Neighbouring rules with the same need, which is checked once for all of them."""
    return [(needs, list(some)) for needs, some in groupby(rules, key=lambda rule: rule.needs)]


def redact_pii(text: Column, rules: Sequence[PiiRule]) -> Column:
    def step(needs: str, some: list[PiiRule]) -> Expression:
        def masked(before: Column) -> Column:
            after = before
            for rule in some:
                after = _masked(after, rule)
            return F.when(before.rlike(needs), after).otherwise(before)

        return masked

    for needs, some in _by_need(rules):
        text = tx.bind(text, step(needs, some))
    return text


def pii_filter(
    entities: str | Sequence[str] = "pii", gazetteer: Gazetteer | None = None, redact: bool = True
) -> Rule:
    """Any personal data of the given kinds is a violation; the repair masks it."""
    rules = rules_for(entities, gazetteer)

    def risk(text: Column) -> Column:
        found = F.lit(False)
        for needs, some in _by_need(rules):
            patterns = "|".join(f"(?:{_pattern(rule)})" for rule in some)
            found = found | (text.rlike(needs) & text.rlike(patterns))
        return flag(found)

    fix = (lambda text: redact_pii(text, rules)) if redact else (lambda text: text)
    return Rule("pii_filter", risk, fix)


def count_pii(
    df: DataFrame, text: str, rules: Sequence[PiiRule], by: Sequence[str]
) -> DataFrame:
    """Hits per group and entity, read off the placeholders that masking adds."""
    redacted = df.withColumn("__redacted", redact_pii(F.col(text), rules))
    marks = {rule.entity: rf"<{rule.entity}>" for rule in rules}
    added = {
        entity: F.sum(tx.count(F.col("__redacted"), mark) - tx.count(F.col(text), mark))
        for entity, mark in marks.items()
    }
    wide = redacted.groupBy(*by).agg(*[total.alias(entity) for entity, total in added.items()])
    return wide.unpivot(list(by), list(marks), "entity", "n_hits")


def _mark(number: int) -> str:
    """Stands for a value of the rule of that number; no rule matches it, or across it."""
    return f"<{chr(FIRST_MARK + number)}>"


def spliced(text: Column, marks: Column | str, values: Column) -> Column:
    """Put the values, in order, where the marks are: one pass over the text."""
    pieces = F.split(text, marks, -1)
    return F.array_join(
        F.zip_with(pieces, values, lambda piece, value: F.concat(piece, F.coalesce(value, F.lit("")))), ""
    )


def _placeholder(entity: str, number: Column) -> Column:
    return F.concat(F.lit(f"[REDACTED_{entity}_"), number.cast("string"), F.lit("]"))


def _entries(entity: str, distinct: Column) -> Column:
    """Vault entries of one text: values numbered by first appearance."""
    return F.transform(
        distinct,
        lambda value, at: F.struct(
            F.lit(entity).alias("entity_type"),
            (at + 1).cast("int").alias("idx"),
            value.alias("value"),
            _placeholder(entity, at + 1).alias("placeholder"),
        ),
    )


def _placeholders(entity: str, values: Column, distinct: Column) -> Column:
    """The placeholder of each value; a value that is not numbered stays."""

    def of_value(names: Column, value: Column) -> Column:
        at = F.array_position(names, value)
        return F.when(at > 0, _placeholder(entity, at)).otherwise(value)

    return tx.bind(distinct, lambda names: F.transform(values, lambda value: of_value(names, value)))


def anonymize(
    df: DataFrame,
    text: str,
    entities: str | Sequence[str] = "pii",
    allowed_names: Sequence[str] = (),
    hidden_names: Sequence[str] = (),
    gazetteer: Gazetteer | None = None,
    out: str = "scan",
) -> DataFrame:
    """Replace each value by a numbered placeholder and keep the pairs as ``vault``.

    The same value gets the same placeholder throughout a text. Values are replaced where
    they were found and nowhere else, and allowed names stay. What looks like a
    placeholder in the source gets one itself, as LITERAL, which is no violation;
    so ``restore`` always gives the source back.

    Each rule leaves marks in the text and its values in order; every step is a projection of its
    own, so that it runs once although several others read it. Then the marks of each rule
    are filled with the placeholders of its values.
    """
    custom = tx.any_of(hidden_names)
    own = [PiiRule(MARKS, f"[{chr(FIRST_MARK)}-{chr(FIRST_MARK + 255)}]", edges=False, needs="")]
    literal = [PiiRule(LITERAL, PLACEHOLDER, edges=False, needs=r"\[REDACTED_")]
    hidden = [PiiRule(CUSTOM, custom, needs=custom)] if hidden_names else []
    steps = [*own, *literal, *hidden, *rules_for(entities, gazetteer)]
    allowed = F.array(*[F.lit(name) for name in allowed_names]).cast("array<string>")
    none = F.array().cast("array<string>")
    before = list(df.columns)
    df = df.withColumn("__text_0", F.col(text))
    for at, rule in enumerate(steps):
        masked = F.regexp_replace(
            f"__text_{at}", _pattern(rule), ("$1" if rule.lead else "") + _mark(at)
        )
        here = F.col(f"__text_{at}")
        found = F.when(here.rlike(rule.needs or rule.pattern), _values(here, rule))
        df = df.withColumn(f"__values_{at}", F.coalesce(found, none)).withColumn(
            f"__text_{at + 1}",
            F.when(F.size(f"__values_{at}") > 0, masked).otherwise(F.col(f"__text_{at}")),
        )
    vaults = []
    df = df.withColumn("__filled_0", F.col(f"__text_{len(steps)}"))
    for turn, at in enumerate(reversed(range(len(steps)))):
        values, filled = F.col(f"__values_{at}"), F.col(f"__filled_{turn}")
        put = values
        if steps[at].entity != MARKS:
            distinct = F.array_except(values, allowed)
            vaults.insert(0, _entries(steps[at].entity, distinct))
            put = _placeholders(steps[at].entity, values, distinct)
        df = df.withColumn(
            f"__filled_{turn + 1}",
            F.when(F.size(values) > 0, spliced(filled, _mark(at), put)).otherwise(filled),
        )
    df = df.withColumn("vault", F.flatten(F.array(*vaults)))
    seen = F.exists("vault", lambda entry: entry["entity_type"] != LITERAL)
    risk = F.when(F.col(text).isNotNull(), flag(seen))
    verdict = F.struct(
        F.col(f"__filled_{len(steps)}").alias("sanitized"),
        (risk < 1).alias("is_valid"),
        risk.alias("risk_score"),
    )
    return df.withColumn(out, verdict).select(*before, "vault", out)


def vault_table(anonymized: DataFrame, *keys: str) -> DataFrame:
    """One row per vault entry, to be kept apart from the texts."""
    return anonymized.select(*keys, F.inline_outer("vault")).filter(F.col("idx").isNotNull())


def restore(text: str, vault: str = "vault") -> Column:
    """Put the vaulted values back into an anonymized text, in one pass over it."""
    held = F.map_from_entries(
        F.transform(vault, lambda entry: F.struct(entry["placeholder"], entry["value"]))
    )
    found = tx.extract(F.col(text), PLACEHOLDER, 0)
    values = tx.bind(
        held, lambda known: F.transform(found, lambda mark: F.coalesce(known[mark], mark))
    )
    return spliced(F.col(text), PLACEHOLDER, values)
