"""Limits and chunks in the tokens of a public vocabulary. SQL has no byte-pair merges: the tests
compare with another encoder of the same vocabulary."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from registry import query
from textguard.operators import model_tokens
from textguard.operators.rule import scan
from textguard.sources.tables import text_table

RANKS = os.environ.get("TEXTGUARD_RANKS", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
LIMIT = 256


@query("model_token_limit")
def model_token_limit(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    rule = model_tokens.model_token_limit(model_tokens.load_ranks(spark, RANKS), LIMIT)
    done = scan(docs, "text", rule, out=["scan"])
    return done.select("doc_id", "scan.sanitized", "scan.is_valid", "scan.risk_score", "scan.n_tokens")


@query("model_token_chunks")
def model_token_chunks(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    cut = model_tokens.model_chunks(model_tokens.load_ranks(spark, RANKS), LIMIT)
    chunks = docs.select("doc_id", F.posexplode(cut(F.col("text"))).alias("pos", "part"))
    return chunks.select("doc_id", "pos", "part.chunk", "part.n_tokens")
