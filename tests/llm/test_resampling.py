"""Importance resampling and position-table CRC against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from textguard.llm.crc import BLOCK, PositionTable
from textguard.llm.resampling import resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, weight string, score string, rank int, id long, place int"


def test_crc_of_spans_of_any_length():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 4000).astype(np.uint8)
    edges = [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK, 3 * BLOCK + 1, 1000]
    starts = np.array([at for at in (0, 7, 2999) for _ in edges])
    ends = starts + np.array(edges * 3)
    expected = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert PositionTable().crc32(data, starts, ends).tolist() == expected
    assert PositionTable(3).crc32(data, starts, ends).tolist() == expected
    assert PositionTable().crc32(data[:0], starts[:0], ends[:0]).tolist() == []


def features(text, buckets):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    both = found + [f"{a} {b}" for a, b in zip(found, found[1:])]
    return [zlib.crc32(feature.encode()) % buckets for feature in both], len(found)


def brute(docs, items, buckets, percent, min_words):
    held = [features(text, buckets) for _, text in docs]
    s = Counter(bucket for found, _ in held for bucket in found)
    t = Counter(bucket for (text,) in items for bucket in features(text, buckets)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for (doc_id, _), (found, words) in zip(docs, held):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        key = f"7:{'null' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, weight + noise, None, words])
    able = [row for row in rows if row[5] >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(row[:5]) for row in rows), key=repr)


TEXTS = [
    None,
    "",
    " \n ",
    "One",
    "one two, ONE TWO",
    "Été à l'été; 中文 ÀB été",
    "x" * 1000 + " " + "y" * 70,
    " ".join(f"w{i % 7}" for i in range(40)),
    " ".join(f"Word{i}" for i in range(3000)),
    "nul\x00byte under_score 1-2-3",
]


@pytest.fixture
def rows():
    held = [(i, text) for i, text in enumerate(TEXTS * 3)]
    return held + [(4, TEXTS[8]), (4, TEXTS[8]), (None, TEXTS[7]), (None, TEXTS[8])]


@pytest.mark.parametrize(("buckets", "min_words"), [(10_000, 20), (13, 0)])
def test_against_plain_python(spark, rows, buckets, min_words):
    items = [("one two three",), (None,), ("été w3 w4",)]
    docs = spark.createDataFrame([(*row, "x", "y", 1, 2, 3) for row in rows], SCHEMA)
    target = spark.createDataFrame(items, "text string")
    drawn = resample(docs, target, percent=40, min_words=min_words, buckets=buckets)
    assert drawn.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(row) for row in drawn.collect()), key=repr)
    assert got == brute(rows, items, buckets, 40, min_words)


def test_words_across_stretches(spark, monkeypatch, rows):
    from textguard.llm import resampling

    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", 7)
    items = [(TEXTS[8],)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = resample(docs, spark.createDataFrame(items, "text string"))
    got = sorted((tuple(row) for row in drawn.collect()), key=repr)
    assert got == brute(rows, items, 10_000, 25, 20)


def test_empty_tables(spark, rows):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert resample(nothing, docs).count() == 0
    drawn = resample(docs, nothing, carry=["text"])
    assert drawn.count() == len(rows)
    assert {row.weight for row in drawn.collect() if row.n_features == 0} == {0}
