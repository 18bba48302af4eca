"""Byte-pair tokens against another encoder of the same vocabulary."""

import base64
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from textguard.functions import bpe
from textguard.operators import model_tokens
from textguard.operators.rule import scan

FILES = sorted(glob.glob("/opt/tokenizers/byte_bpe*.tiktoken"))
tiktoken = pytest.importorskip("tiktoken")
TEXTS = [
    "The quick brown fox's tail, it'll don't  stop!\n\n  Indented\tline ",
    "Été à l'été; 中文ÀB 🙂🙂 ñandú größe 12345 3.14",
    "x" * 3000,
    "aaaa bbbb " * 500,
    " nbsp 　wide em  ",
    "",
    " ",
    "\x00\x1f control",
]


@pytest.fixture(scope="module", params=FILES, ids=os.path.basename)
def vocabulary(request):
    with open(request.param) as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, file)}
    pattern = bpe.PIECE.removeprefix("(?U)")
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return request.param, other


def test_ids_are_those_of_another_encoder(spark, texts, vocabulary):
    path, other = vocabulary
    held = model_tokens.load_ranks(spark, path)
    docs = [row.text for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    many = TEXTS + docs
    df = texts(*many, None).withColumn("ids", model_tokens.token_ids(held)(F.col("text"))).orderBy("id")
    got = [row.ids for row in df.collect()]
    assert got[-1] is None
    assert got[:-1] == other.encode_ordinary_batch(many)


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_chunks_and_limits(spark, texts, vocabulary, limit):
    path, other = vocabulary
    held = model_tokens.load_ranks(spark, path)
    cut = model_tokens.model_chunks(held, limit)
    rows = texts(*TEXTS).withColumn("chunks", cut(F.col("text"))).orderBy("id").collect()
    for row in rows:
        assert "".join(chunk.chunk for chunk in row.chunks) == row.text
        assert all(c.n_tokens <= limit or len(c.chunk) == 1 for c in row.chunks)
    rule = model_tokens.model_token_limit(held, limit)
    for row, done in zip(rows, scan(texts(*TEXTS), "text", rule).orderBy("id").collect()):
        count = len(other.encode_ordinary(row.text))
        found = done.model_token_limit
        assert found.n_tokens == count and found.is_valid == (count <= limit)
        assert found.sanitized == (row.text if count <= limit else row.chunks[0].chunk)


def test_long_pieces_take_little_time(vocabulary):
    with open(vocabulary[0]) as file:
        ranks = bpe.parse_ranks(file)
    piece = ("ab" * 100_000).encode()
    began = time.time()
    assert sum(map(len, [bpe.encode(piece, ranks)])) > 0
    assert time.time() - began < 10
