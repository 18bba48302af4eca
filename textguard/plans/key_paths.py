"""Distinct field names of JSON documents, as dotted paths.

Documents of the same shape have the same paths, so one pass reduces the whole
collection to one sample per shape; only the samples are walked level by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.session import stage


def _skeleton(json: Column) -> Column:
    """The JSON text without its scalars. Escapes become control characters, which
    JSON text cannot hold, so that a quote always ends a string. All that is neither
    a name nor a bracket, comma or colon is a scalar; no match is tried twice."""
    plain = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\x02")), F.lit('\\"'), F.lit("\x01"))
    return F.regexp_replace(plain, r'("[^"]*+":)|"[^"]*+"|[^"{}\[\],:]++', "$1")


def _shape(value: Column) -> Column:
    """Equal shapes imply equal paths. The schema is the shape, unless it merges
    values of different kinds and so hides the paths below them; then the value
    without its scalars is."""

    def shape(schema: Column) -> Column:
        return F.when(schema.contains("VARIANT"), _skeleton(F.to_json(value))).otherwise(schema)

    return tx.bind(F.schema_of_variant(value), shape)


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def listed_keys(data: Column) -> Column:
    """The string ``key`` of each entry of the top-level list ``key_values``."""
    entries = F.try_variant_get(data, "$.key_values", "array<variant>")

    def name(entry: Column) -> Column:
        key = F.try_variant_get(entry, "$.key", "variant")
        return F.when(F.schema_of_variant(key) == "STRING", F.try_variant_get(entry, "$.key", "string"))

    return F.array_compact(F.coalesce(F.transform(entries, name), F.array().cast("array<string>")))


def document_samples(documents: DataFrame) -> DataFrame:
    """One pass over all documents: the distinct listed keys (``kind`` = key), and
    a sample and the number of documents per shape (``kind`` = shape), staged.

    A document without data is left out here, after the pass: a filter before it
    would parse every document twice.
    """
    data = F.col("data")
    nothing = F.lit(None).cast("variant")
    rows = F.concat(
        F.transform(
            listed_keys(data),
            lambda key: F.struct(F.lit("key").alias("kind"), key.alias("name"), nothing.alias("sample")),
        ),
        F.array(F.struct(F.lit("shape").alias("kind"), _shape(data).alias("name"), data.alias("sample"))),
    )
    samples = (
        documents.select(F.inline_outer(rows))
        .groupBy("kind", "name")
        .agg(F.first("sample").alias("sample"), F.count(F.lit(1)).alias("n"))
    )
    return stage(samples.filter(F.col("name").isNotNull()), "samples")


def _children(parents: DataFrame) -> DataFrame:
    """(path, value) of every field of the parent objects, one sample per shape."""
    tvf = parents.sparkSession.tvf
    fields = parents.lateralJoin(tvf.variant_explode(F.col("parent").outer())).select(
        F.when(F.col("prefix") == "", F.col("key"))
        .otherwise(F.concat("prefix", F.lit("."), "key"))
        .alias("path"),
        "value",
    )
    return fields.groupBy("path", _shape(F.col("value")).alias("shape")).agg(
        F.first("value").alias("value")
    )


def _parents(children: DataFrame) -> DataFrame:
    """The objects to enter next: object fields, and objects directly in an array."""
    value = F.col("value")
    items = F.when(_is_object(value), F.array(value)).otherwise(
        F.try_variant_get(value, "$", "array<variant>")
    )
    return children.select(F.col("path").alias("prefix"), F.explode(items).alias("parent")).filter(
        _is_object(F.col("parent"))
    )


def nested_paths(samples: DataFrame) -> DataFrame:
    """Distinct paths of all fields at all levels; one step per level of nesting."""
    parents = (
        samples.filter((F.col("kind") == "shape") & _is_object(F.col("sample")))
        .select(F.lit("").alias("prefix"), F.col("sample").alias("parent"))
    )
    paths = None
    while not parents.isEmpty():
        level = stage(_children(parents), "level")
        found = level.select("path")
        paths = found if paths is None else paths.union(found)
        parents = _parents(level)
    if paths is None:
        return samples.select(F.col("name").alias("key")).limit(0)
    return paths.select(F.col("path").alias("key")).distinct()


def count_documents(samples: DataFrame) -> Column:
    shapes = samples.filter(F.col("kind") == "shape")
    return shapes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()


def distinct_keys(samples: DataFrame) -> DataFrame:
    """(key): all listed keys and nested paths, each once."""
    listed = samples.filter(F.col("kind") == "key").select(F.col("name").alias("key"))
    return listed.union(nested_paths(samples)).distinct()
