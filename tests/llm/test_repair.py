"""Conversation repair against a shortest-path search over rows and states."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from textguard.llm import repair
from textguard.llm.turns import Grammar, Rope

COLUMNS = "conv_id long, turn long, role string, text string, cost string, audit int, conv long, n int, part string"


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        spaced = [" " if value is None else str(value) for value in (conv, turn, role, text)]
        code = zlib.crc32(":".join(spaced[:2]).encode()) % 20
        role, text = spaced[2:]
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired turns) by Dijkstra, the smaller audit first among equals."""
    heap, done = [(0, "", 0, "0", ())], set()
    while True:
        cost, audit, at, state, turns = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in "0a":
            return cost, audit, turns
        needed = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", at, needed[0], (*turns, (needed, ""))))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, turns))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = cost + (faults[at] == "truncated")
        heapq.heappush(heap, (more + 2, audit + "R", at + 1, needed[0], (*turns, (needed, text))))
        if role[:1] == needed[0] or (state == "0" and role[:1] == "s"):
            heapq.heappush(heap, (more, audit + "K", at + 1, role[0], (*turns, (role, text))))


def brute(rows):
    out = {}
    for conv, held in damaged(rows).items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = {turn for turn, _, _ in held if turn is not None}
        faults, seen = [], set()
        for _, role, text in held:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            if not solid:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("none" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in held]
        cost, audit, repaired = cheapest(held, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(fault) for fault in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def repaired(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.repair(repair.damage(df), copies="copies").collect()
    assert len({row[0] for row in found}) == len(found)
    return {row[0]: tuple(row)[1:] for row in found}


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "Sales"]
    texts = ["Yes.", "no", "ok.", " \n", None, "Hm?\t", "été. ", "中文", "long " * 3000 + "."]
    out = []
    for conv in [None, *range(30)]:
        for k in range(700 if conv == 7 else rng.choice([1, 2, 5, 12])):
            text = rng.choice([*texts, f"x{k}.", f"x{k}."])
            out.append((conv, rng.choice([None, k, k, k + 3, -5]), rng.choice(roles), text))
    return out


def test_against_shortest_paths(spark, odd):
    assert repaired(spark, odd) == brute(odd)


def test_parts_of_one_conversation(spark, odd, monkeypatch):
    monkeypatch.setattr(repair, "PART_LETTERS", 5)
    assert repaired(spark, odd) == brute(odd)


def test_dropped_empty_and_clashing(spark):
    assert repaired(spark, []) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(gone, 0, "user", "a.")]) == {gone: (0, 0, 0, 0, 0, 0, "", nothing)}
    wide = spark.createDataFrame([(1, 1, "user", "a.", "x", 2, 3, 4, "y")], COLUMNS)
    row = repair.repair(wide).first()
    assert (row.conv_id, row.cost, row.audit) == (1, 2, "KI")
    far = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    assert repair.repair(spark.createDataFrame(far, COLUMNS.split(", cost")[0])).first().gaps is None


def test_grammar_changes_nothing():
    plain, packed = Grammar(), Grammar()
    rng = random.Random(2)
    for pair in ("ae", "ei", "ie"):
        packed.add(pair)
    packed.add(packed.rules[1][0] + packed.rules[1][0])
    for _ in range(300):
        text = "".join(rng.choice("aeeiilmfgqj".replace("q", "h")) for _ in range(rng.randrange(30)))
        assert plain.cheapest([plain.matrix(text)]) == packed.cheapest([packed.matrix(text)])


def test_ropes_order_as_strings():
    rng = random.Random(3)
    pool = [Rope(c * n) for c in "DIKR" for n in (1, 40, 70)]
    for _ in range(200):
        pool.append(rng.choice(pool).join(rng.choice(pool)))
    for _ in range(2000):
        a, b = rng.choice(pool), rng.choice(pool)
        assert (a < b) == (str(a) < str(b))
