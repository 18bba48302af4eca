"""The whole pipeline against five stages in plain Python, row by row."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from textguard import session
from textguard.llm import quality, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, measured int, "
    "posterior string, base_failed int, copies string, slot string, __key string, label string"
)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def votes(text):
    """(base rule failed, votes), straight from the rules' descriptions."""
    body, words = text or "", words_of(text)
    n, chars = len(words), sum(map(len, words))
    windows = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    hit = {k for i in range(n - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [line for line in body.split("\n") if words_of(line)]
    symbols = sum(c in "#*$%&|<>" for c in body)
    capitals = sum(c.isupper() for c in body)
    repeats = 100 * len(hit)
    held = [
        -(symbols * 10 > n),
        -(capitals * 2 > chars),
        -(body.count("!") * 4 > n),
        -(sum(a == b for a, b in zip(words, words[1:])) * 5 > n),
        -(repeats > 30 * n),
        -((len(lines) - len(set(lines))) * 2 > len(lines)),
        -(chars > 40 * n),
        -(symbols * 10 <= n and symbols * 50 > n),
        -(capitals * 2 <= chars and capitals * 5 > chars),
        -(repeats <= 30 * n and repeats > 15 * n),
        int(2 * n <= chars <= 12 * n),
    ]
    return n < 20 or repeats > 30 * n, tuple(held)


def by_quality(rows):
    judged = [votes(row[1]) for row in rows]
    assumed = [accuracy for _, _, accuracy in quality.RULES]
    counts, accuracies = Counter(v for _, v in judged), list(assumed)

    def good(pattern):
        odds = sum(v * math.log(a / (1 - a)) for v, a in zip(pattern, accuracies))
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        chance = {pattern: good(pattern) for pattern in counts}
        accuracies = [
            (quality.PSEUDO * a + sum(n * (a + (chance[p] if p[r] > 0 else 1 - chance[p])) for p, n in counts.items() if p[r]))
            / (quality.PSEUDO + sum(2 * n for p, n in counts.items() if p[r]))
            for r, a in enumerate(assumed)
        ]
    return [row for row, (failed, v) in zip(rows, judged) if not failed and good(v) >= 0.5]


def without_near_copies(rows):
    def shingles(text):
        words = words_of((text or "").translate(LOWER))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets = [shingles(row[1]) for row in rows]
    label = {row[0]: row[0] for row in rows if row[0] is not None}

    def join(a, b):
        low, high = sorted((label[a], label[b]))
        for key in label:
            if label[key] == high:
                label[key] = low

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if None not in (a[0], b[0]) and sets[i] and sets[j]:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    join(a[0], b[0])
    seen, out = set(), []
    for row in rows:
        if row[0] is None or (label[row[0]] == row[0] and row[0] not in seen):
            seen.add(row[0])
            out.append(row)
    return out


def without_benchmark(rows, items):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = set()
    for item in items:
        words = split(item)
        n = min(10, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    sizes = {len(window) for window in windows}

    def clean(text):
        words = split(text)
        return not any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))

    return [row for row in rows if clean(row[1])]


def mixed(rows):
    size = [len(words_of(row[1])) for row in rows]
    place = [int(md5(f"mix:{'null' if r[0] is None else r[0]}:{md5(r[1] or '')}")[:12], 16) for r in rows]
    sources = sorted({row[3] for row in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for row, n in zip(rows, size) if row[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[at % 3] for at, s in enumerate(sources)}
    full: set = set()
    while True:
        rest = [s for s in sources if s not in full]
        if not rest:
            break
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in full)) / sum(weight[s] for s in rest)
        over = {s for s in rest if 2 * total[s] <= level * weight[s]}
        if not over:
            break
        full |= over
    out = []
    for s in sources:
        target = 2 * total[s] if s in full else level * weight[s]
        whole = math.floor(target / total[s]) if total[s] else 0
        left, limit = target - whole * total[s], -1
        values = Counter()
        for row, n, h in zip(rows, size, place):
            if row[3] == s:
                values[h] += n
        upto = 0
        for h in sorted(values):
            if left > 0 and upto + values[h] >= left:
                rest = left - upto
                limit = h + 1 if values[h] - rest <= rest else h
                break
            upto += values[h]
        for row, n, h in zip(rows, size, place):
            if row[3] == s and n:
                out += [row] * (whole + (h < limit))
    return out


def placed(rows):
    owners = sharding.slot_owners()
    slots = [int(md5(f"shard:{'null' if row[0] is None else row[0]}")[:12], 16) % sharding.SLOTS for row in rows]
    return Counter((*row[:4], slot, owners[slot]) for row, slot in zip(rows, slots))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    texts = [prose(rng.randrange(15, 90)) for _ in range(60)]
    passage = prose(12)
    texts += [texts[0], texts[1] + " extra", texts[2].upper(), f"{texts[3]} {passage} end", passage.title()]
    texts += ["# $ % & " * 20, (prose(9) + "\n") * 12, "stop " * 50, None, "", " \n", "ÀÉ ß 中文 " * 12, prose(4000)]
    texts += [t + " ! # one" for t in texts[5:30]] + ["A" + t.upper()[: len(t) // 3] + t for t in texts[30:40]]
    ids = [*range(len(texts) - 2), None, None]
    out = [(i, t, "en", rng.choice(["a", "b", "c", None, "é"]), 1) for i, t in zip(ids, texts)]
    out += [out[0], out[7], (9, texts[9] + " z", "en", "a", 1)]
    return out, passage


def test_every_row(spark, rows, tmp_path, monkeypatch):
    docs, passage = rows
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    monkeypatch.setattr(session, "work_folder", lambda spark: work)
    wide = [(*row, "k", 1, "p", 2, "c", "s", "y", "l") for row in docs]
    spark.createDataFrame(wide, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    items = [passage, "rare", None, ""]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    done = corpus_pipeline.run(spark, folder).collect()
    steps = [by_quality(docs)]
    steps.append(without_near_copies(steps[-1]))
    steps.append(without_benchmark(steps[-1], items))
    steps.append(mixed(steps[-1]))
    assert len(docs) > len(steps[0]) > len(steps[1]) > len(steps[2]) > 20
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.slot, r.shard) for r in done) == placed(steps[-1])
    assert {(r.kept, r.measured, r.copies, r["__key"], r.label) for r in done} == {("k", 1, "c", "y", "l")}
    # What the stages staged is gone; the rows themselves stay.
    assert [name.rsplit("-", 1)[0] for name in os.listdir(work)] == ["pipeline-sharding"]


def test_empty_documents(spark, rows, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, rows[1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
