"""A corpus pipeline: rules, near-duplicates, benchmark passages, mixture, shards.

Each stage takes the documents that the stage before kept, works on all of them, and
is written to Parquet and read back before the next. All but the last return the
columns of ``documents``; the last adds ``slot`` and ``shard``.

Rows are handled by document id and text together, so repeated ids do no harm; NULL
ids, texts and sources are handled as each operator's docstring says; empty tables pass
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.llm import minhash, mixing, quality, sharding, winnow
from textguard.session import drop_folder, new_path, scratch
from textguard.sources.tables import table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules take for good. Texts are measured twice, for the counts
    of votes and for the verdicts, so that they are neither written nor shuffled in between."""
    rows = docs.select(F.struct(*[F.col(name) for name in docs.columns]).alias("__row"), "text")
    judged = quality.judge(quality.measure(rows, "text"))
    return judged.filter("kept").select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near copies: five words, 0.8."""
    return minhash.drop_near_duplicates(docs).select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return winnow.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it: not at all, once or twice."""
    return mixing.take(docs)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the shard that its document id belongs to."""
    return sharding.place(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("mix_sources", mix_sources),
    ("sharding", place_on_shards),
]

# Links of near copies reach along chains of unknown length, and the stages' rounds of
# estimates nest: the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; what a stage read or staged goes when its rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, apply in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark):
            apply(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
