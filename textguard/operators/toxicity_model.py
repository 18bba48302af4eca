"""A toxicity classifier learned from labelled texts, beside the word list."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx

FEATURES = 1 << 16
TOKENS = "__tokens"


def _tokenized(df: DataFrame, text: str) -> DataFrame:
    words = F.coalesce(tx.words(F.col(text)), F.array().cast("array<string>"))
    return df.withColumn(TOKENS, words)


def train_toxicity(labelled: DataFrame, text: str, label: str) -> PipelineModel:
    """Hashed word counts, weighted by rarity, into a logistic regression.

    The model has one weight per hashed feature, however many texts it learns from.
    """
    stages = [
        HashingTF(inputCol=TOKENS, outputCol="__counts", numFeatures=FEATURES),
        IDF(inputCol="__counts", outputCol="__features", minDocFreq=2),
        LogisticRegression(
            featuresCol="__features", labelCol=label, probabilityCol="__chances", regParam=0.1, maxIter=30
        ),
    ]
    usable = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    return Pipeline(stages=stages).fit(_tokenized(usable, text).select(TOKENS, label))


def toxicity_by_model(
    df: DataFrame, key: str, text: str, model: PipelineModel, threshold: float = 0.5
) -> DataFrame:
    """(key, is_valid, risk_score): the learned chance of being toxic."""
    known = F.col(text).isNotNull()
    scored = model.transform(_tokenized(df, text).select(key, TOKENS, known.alias("known")))
    risk = F.when(F.col("known"), F.round(vector_to_array("__chances")[1], 6))
    return scored.select(key, (risk < threshold).alias("is_valid"), risk.alias("risk_score"))
