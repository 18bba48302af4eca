"""The whole job: JSON documents in, standard field names out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.plans.key_clusters import cluster_keys
from textguard.plans.key_names import cluster_names, grouped_map, key_report, standard_map
from textguard.plans.key_paths import count_documents, distinct_keys, document_samples
from textguard.session import stage
from textguard.sources.json_folder import read_json_folder

OK = "ok"
NO_FILES = "no usable JSON documents"
NO_KEYS = "no keys"


@dataclass(frozen=True)
class Standardized:
    """Results as tables; all but the report are empty if there was nothing to do."""

    status: str
    report: DataFrame
    mapping: DataFrame
    names: DataFrame
    bad_files: DataFrame | None = None


def standardize_documents(
    documents: DataFrame, overrides: DataFrame | None = None, bad_files: DataFrame | None = None
) -> Standardized:
    samples = document_samples(documents)
    clusters = stage(cluster_keys(distinct_keys(samples)), "clusters")
    names = stage(cluster_names(clusters, overrides), "names")
    mapping = stage(standard_map(clusters, names), "mapping")
    status = OK
    if mapping.isEmpty():
        status = NO_FILES if samples.isEmpty() else NO_KEYS
    report = key_report(count_documents(samples), mapping).withColumn("status", F.lit(status))
    return Standardized(status, report, mapping, names, bad_files)


def standardize_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.json",
    overrides: DataFrame | None = None,
) -> Standardized:
    documents, bad_files = read_json_folder(spark, folder, pattern)
    return standardize_documents(documents, overrides, bad_files)


def preview(mapping: DataFrame, rows: int = 10) -> DataFrame:
    return mapping.select("key", "standard_key").orderBy("key").limit(rows)


def save_results(result: Standardized, folder: str) -> str:
    """Write report, mapping, names and grouped mapping as JSON below a stamped
    folder, and return it. Nothing is written if there is no mapping."""
    if result.status != OK:
        return ""
    run = f"{folder.rstrip('/')}/key_standardization_{datetime.now():%Y%m%d_%H%M%S}"
    result.report.write.json(f"{run}/report")
    result.mapping.write.json(f"{run}/mapping")
    result.names.write.json(f"{run}/names")
    grouped_map(result.mapping).write.json(f"{run}/grouped")
    return run
