"""How much an output has to do with its prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.plans.skew import spread_join
from textguard.session import stage


def relevance(
    pairs: DataFrame,
    keys: Sequence[str],
    prompt: str = "prompt",
    output: str = "output",
    threshold: float = 0.5,
) -> DataFrame:
    """TF-IDF cosine of prompt and output, each text counting as one document.

    The pairs are read once. Their words are counted per pair first, next to one
    marker row without a word that keeps a pair without words in the result; from
    there on only numbers travel. The join that adds each word's weight spreads the
    frequent words.
    """
    marker = F.array(F.lit(None).cast("string"))

    def side(text: str, is_prompt: int) -> Column:
        found = F.coalesce(tx.words(F.col(text)), F.array().cast("array<string>"))
        return F.struct(
            F.lit(is_prompt).alias("p"),
            F.lit(1 - is_prompt).alias("o"),
            F.concat(found, marker).alias("words"),
            F.col(text).isNotNull().cast("int").alias("known"),
        )

    terms = stage(
        pairs.select(*keys, F.inline(F.array(side(prompt, 1), side(output, 0))))
        .select(*keys, "p", "o", "known", F.explode("words").alias("term"))
        .groupBy(*keys, "term")
        .agg(F.sum("p").alias("tf_p"), F.sum("o").alias("tf_o"), F.sum("known").alias("known")),
        "terms",
    )
    words = terms.filter(F.col("term").isNotNull()).select(*keys, "term", "tf_p", "tf_o")
    markers = terms.filter(F.col("term").isNull()).select(*keys, "known")
    texts_with = F.count_if(F.col("tf_p") > 0) + F.count_if(F.col("tf_o") > 0)
    vocabulary = stage(words.groupBy("term").agg(texts_with.alias("df")), "vocabulary")
    weighed = spread_join(words, vocabulary, "term", lambda: (vocabulary, "df"), keys)
    n_texts = markers.agg(F.sum("known")).scalar()
    idf = F.log((1 + n_texts) / (1 + F.col("df"))) + 1
    zero, unknown = F.lit(0.0), F.lit(None).cast("long")
    parts = weighed.select(
        *keys, (F.col("tf_p") * idf).alias("wp"), (F.col("tf_o") * idf).alias("wo"), unknown.alias("known")
    ).union(markers.select(*keys, zero, zero, "known"))
    cosines = parts.groupBy(*keys).agg(
        F.sum(F.col("wp") * F.col("wo")).alias("dot"),
        F.sum(F.col("wp") * F.col("wp")).alias("pp"),
        F.sum(F.col("wo") * F.col("wo")).alias("oo"),
        F.max("known").alias("known"),
    )
    cosine = F.coalesce(F.try_divide(F.col("dot"), F.sqrt(F.col("pp") * F.col("oo"))), F.lit(0.0))
    similarity = F.when(F.col("known") == 2, F.round(cosine, 6))
    return cosines.withColumn("similarity", similarity).select(
        *keys,
        "similarity",
        (F.col("similarity") >= threshold).alias("is_valid"),
        F.round(1 - F.col("similarity"), 6).alias("risk_score"),
    )


def vector_relevance(
    pairs: DataFrame, keys: Sequence[str], prompt: str, output: str, threshold: float = 0.5
) -> DataFrame:
    """The same judgement from two embedding columns."""
    similarity = F.round(tx.cosine(F.col(prompt), F.col(output)), 6)
    return pairs.select(*keys, similarity.alias("similarity")).select(
        *keys,
        "similarity",
        (F.col("similarity") >= threshold).alias("is_valid"),
        F.round(1 - F.col("similarity"), 6).alias("risk_score"),
    )
