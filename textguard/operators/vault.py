"""One vault for all texts: a value has the same placeholder wherever it stands."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.operators.pii import LITERAL, PLACEHOLDER, anonymize, spliced, vault_table
from textguard.plans.skew import number_rows, spread_join
from textguard.session import scratch, stage


class Vaulted(NamedTuple):
    """``texts`` (key, sanitized, is_valid) and ``vault`` (entity_type, idx, value, placeholder)."""

    texts: DataFrame
    vault: DataFrame


def _relabelled(texts: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """Exchange the placeholders of each text for others: ``labels`` has (key, old, new). Texts meet
    one map each, by a broadcast where these are few, and are read once."""
    pairs = F.collect_list(F.struct("old", "new"))
    maps = stage(labels.groupBy(key).agg(F.map_from_entries(pairs).alias("__new")), "vault-maps", keep=True)
    found = tx.extract(F.col(text), PLACEHOLDER, 0)

    def replaced(known: Column) -> Column:
        return F.transform(found, lambda mark: F.coalesce(known[mark], mark))

    def counts() -> tuple[DataFrame, str]:
        return texts.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "n"

    joined = spread_join(texts, maps, key, counts, [text], "left")
    done = F.when(
        F.col("__new").isNotNull(), spliced(F.col(text), PLACEHOLDER, tx.bind(F.col("__new"), replaced))
    ).otherwise(F.col(text))
    return joined.withColumn(text, done).drop("__new")


def anonymize_corpus(df: DataFrame, key: str, text: str, **options) -> Vaulted:
    """Anonymize all texts with one vault; the options are those of ``anonymize``.

    Each text is anonymized in its row first. Then the distinct values of each kind are numbered in
    their order, by range partitions and not in one task, and joined back to the places that
    hold them, with frequent values spread over several tasks. The key identifies rows.
    """
    columns = df.select(key, text)
    with scratch(df.sparkSession):
        local = stage(anonymize(columns, text, **options), "vault-local", keep=True)
        entries = vault_table(local, key).select(
            key, F.struct("entity_type", "value").alias("of"), F.col("placeholder").alias("old")
        )
        entries = stage(entries, "vault-entries")
        distinct = entries.select("of").distinct()
        numbered = stage(number_rows(distinct, "of", "n"), "vault-numbers")
        heads = numbered.groupBy("of.entity_type").agg(F.min("n").alias("head"))
        named = numbered.join(F.broadcast(heads), F.col("of.entity_type") == F.col("entity_type"))
        index = (F.col("n") - F.col("head") + 1).cast("long")
        placeholder = F.concat(F.lit("[REDACTED_"), "entity_type", F.lit("_"), index.cast("string"), F.lit("]"))
        vault = stage(
            named.select("of", "entity_type", index.alias("idx"), "of.value", placeholder.alias("placeholder")),
            "vault",
            keep=True,
        )

        def counts() -> tuple[DataFrame, str]:
            return entries.groupBy("of").agg(F.count(F.lit(1)).alias("n")), "n"

        lookup = vault.select("of", F.col("placeholder").alias("new"))
        labels = spread_join(entries, lookup, "of", counts, [key]).select(key, "old", "new")
        texts = local.select(key, F.col("scan.sanitized").alias("sanitized"), F.col("scan.is_valid"))
        return Vaulted(_relabelled(texts, labels, key, "sanitized"), vault.drop("of"))


def restore_corpus(texts: DataFrame, vault: DataFrame, key: str, text: str = "sanitized") -> DataFrame:
    """Put the values of the vault back into all texts, those that stood there as placeholders too."""
    with scratch(texts.sparkSession):
        marks = F.array_distinct(tx.extract(F.col(text), PLACEHOLDER, 0))
        places = texts.select(key, F.explode(marks).alias("placeholder"))

        def counts() -> tuple[DataFrame, str]:
            return places.groupBy("placeholder").agg(F.count(F.lit(1)).alias("n")), "n"

        met = spread_join(places, vault.select("placeholder", "value"), "placeholder", counts, [key])
        labels = met.select(key, F.col("placeholder").alias("old"), F.col("value").alias("new"))
        return _relabelled(texts, labels, key, text)


def value_report(vault: DataFrame) -> DataFrame:
    """Distinct values per kind, without what only looked like a placeholder."""
    return vault.filter(F.col("entity_type") != LITERAL).groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"))
