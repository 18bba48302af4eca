"""Prompt/output pairs from turns of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.plans.skew import next_in_group


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it."""
    paired = next_in_group(turns, "conv_id", "turn", ["role", "text"])
    return paired.filter(
        (F.col("role") == "user") & (F.col("next.role") == "assistant")
    ).select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.col("next.text").alias("output")
    )
