"""Cheapest repair of a turn sequence: a grammar over faults and min-plus matrices.

A conversation is a string of letters, one per row, for the row's role and first fault.
Four states describe what has been written so far: nothing, a system turn, a user turn,
an answer. A letter is a 4 x 4 matrix of (cost, audit): the cheapest edits that lead from
one state to another over that row, and of those the smallest audit. Matrices are multiplied
with minimum for sum, so a frequent string of letters needs one product for all
conversations that hold it. Audits are ropes: a product joins two of them by reference.

Of two edits of equal cost between the same states neither audit is the beginning of the
other, since the longer would hold further insertions, which cost; so the smaller audit
stays the smaller whatever comes before or after, and the products are exact.

This runs inside tasks and on the driver. The module is pickled by value.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, SYSTEM, USER, ANSWER = range(4)
STATES = range(4)
ROLES = ("s", "u", "a", "o")
FAULTS = ("none", "blank", "duplicate", "truncated")
# One letter per role and fault, and the audit letters with their costs.
LETTERS = "abcdefghijklmnop"
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
FIRST_RULE = 0xE000
LEAF = 64


def letter(role: str, fault: str) -> str:
    return LETTERS[4 * ROLES.index(role) + FAULTS.index(fault)]


class Rope:
    """A string that shares its parts; short ones are joined, long ones refer to halves."""

    __slots__ = ("size", "digest", "text", "left", "right")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.size, self.digest = len(text), _digest(text)
        else:
            self.size = left.size + right.size
            self.digest = (left.digest * pow(BASE, right.size, MODULUS) + right.digest) % MODULUS

    def __reduce__(self):
        return (Rope, (self.text, self.left, self.right))

    def join(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        if self.size + other.size <= LEAF:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.text is not None:
                parts.append(rope.text)
            else:
                todo += [rope.right, rope.left]
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        """By characters: equal parts are passed over by their digests, without being read."""
        mine, yours = [self], [other]
        while mine and yours:
            a, b = mine.pop(), yours.pop()
            if a.size == b.size and a.digest == b.digest:
                continue
            if a.text is not None and b.text is not None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                if a.size > n:
                    mine.append(Rope(a.text[n:]))
                elif b.size > n:
                    yours.append(Rope(b.text[n:]))
            elif b.text is not None or (a.text is None and a.size >= b.size):
                mine += [a.right, a.left]
                yours.append(b)
            else:
                yours += [b.right, b.left]
                mine.append(a)
        return bool(yours) and not mine


MODULUS = (1 << 61) - 1
BASE = 1_000_003


def _digest(text: str) -> int:
    value = 0
    for char in text:
        value = (value * BASE + ord(char)) % MODULUS
    return value


EMPTY = Rope("")
# Per pair of states: (cost, audit), or None where no edits lead there.
Matrix = list[list[tuple[int, Rope] | None]]


def smaller(a: tuple[int, Rope] | None, b: tuple[int, Rope] | None) -> tuple[int, Rope] | None:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def product(left: Matrix, right: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        for via in STATES:
            if left[i][via] is None:
                continue
            cost, audit = left[i][via]
            for j in STATES:
                if right[via][j] is not None:
                    further, rest = right[via][j]
                    out[i][j] = smaller(out[i][j], (cost + further, audit.join(rest)))
    return out


def _matrix(edges: list[tuple[int, int, int, str]]) -> Matrix:
    out: Matrix = [[None] * 4 for _ in STATES]
    for i, j, cost, audit in edges:
        out[i][j] = smaller(out[i][j], (cost, Rope(audit)))
    return out


def insertions() -> Matrix:
    """Turns that may stand between two rows: none, one or two. Three or more lead to no other state."""
    one = [(START, USER), (SYSTEM, USER), (ANSWER, USER), (USER, ANSWER)]
    edges = [(i, i, 0, "") for i in STATES]
    edges += [(i, j, INSERT_COST, INSERT) for i, j in one]
    edges += [(i, ANSWER, 2 * INSERT_COST, 2 * INSERT) for i in (START, SYSTEM)]
    return _matrix(edges)


def letter_matrix(role: str, fault: str) -> Matrix:
    """One row, with what may be inserted before it."""
    edges = [(i, i, DELETE_COST, DELETE) for i in STATES]
    if fault in ("none", "truncated"):
        more = TRUNCATED_COST if fault == "truncated" else 0
        onward = [(START, USER, "u"), (SYSTEM, USER, "u"), (ANSWER, USER, "u"), (USER, ANSWER, "a")]
        edges += [(i, j, REROLE_COST + more, REROLE) for i, j, _ in onward]
        edges += [(i, j, more, KEEP) for i, j, needed in onward if needed == role]
        if role == "s":
            edges.append((START, SYSTEM, more, KEEP))
    return product(insertions(), _matrix(edges))


@dataclass
class Grammar:
    """Rules (symbol, pair), each over letters and earlier symbols, and a matrix per symbol."""

    rules: list[tuple[str, str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.matrices: dict[str, Matrix] = {
            letter(role, fault): letter_matrix(role, fault) for role in ROLES for fault in FAULTS
        }
        self.ending = insertions()
        rules, self.rules = self.rules, []
        for symbol, pair in rules:
            self._enter(symbol, pair)

    def __reduce__(self):
        return Grammar, (self.rules,)

    def _enter(self, symbol: str, pair: str) -> None:
        self.rules.append((symbol, pair))
        self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def add(self, pair: str) -> str:
        """A new symbol for a pair of symbols."""
        symbol = chr(FIRST_RULE + len(self.rules))
        self._enter(symbol, pair)
        return symbol

    def compress(self, text: str) -> str:
        for symbol, pair in self.rules:
            text = text.replace(pair, symbol)
        return text

    def matrix(self, text: str) -> Matrix:
        """The product over a string of letters, by its compressed form."""
        whole: Matrix | None = None
        for symbol in self.compress(text):
            whole = self.matrices[symbol] if whole is None else product(whole, self.matrices[symbol])
        return whole or _matrix([(i, i, 0, "") for i in STATES])

    def cheapest(self, matrices: list[Matrix]) -> tuple[int, str]:
        """(cost, audit) of a conversation in consecutive parts."""
        row: list[tuple[int, Rope] | None] = [(0, EMPTY), None, None, None]
        for matrix in [*matrices, self.ending]:
            row = product([row, *[[None] * 4] * 3], matrix)[START]
        cost, audit = smaller(row[START], row[ANSWER])
        return cost, str(audit)


def pack(matrix: Matrix) -> list[dict | None]:
    """The 16 entries, row by row, as they are written to a table."""
    return [e and {"cost": e[0], "audit": str(e[1])} for row in matrix for e in row]


def unpack(entries: list[dict | None]) -> Matrix:
    flat = [e and (e["cost"], Rope(e["audit"])) for e in entries]
    return [flat[4 * i : 4 * i + 4] for i in STATES]


def illegal_pairs(text: str) -> int:
    """Neighbours whose roles are not system-user, user-answer or answer-user."""
    roles = [LETTERS.index(c) // 4 for c in text]
    legal = {(0, 1), (1, 2), (2, 1)}
    return sum(pair not in legal for pair in zip(roles, roles[1:]))
