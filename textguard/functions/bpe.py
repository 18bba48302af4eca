"""Byte-pair encoding of single pieces by a table of ranks.

It runs inside tasks; the table travels as a broadcast, and the code is pickled by value, so
workers need no copy of the package.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterable

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: how byte-level vocabularies cut a text before merging, for the JVM.
PIECE = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_PIECES = 200_000
MEMO_BYTES = 64
Ranks = dict[bytes, int]


def parse_ranks(lines: Iterable[str]) -> Ranks:
    """Lines of a token in base 64 and its rank, which is its id."""
    pairs = (line.split() for line in lines)
    return {base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if len(pair) == 2}


def encode(piece: bytes, ranks: Ranks) -> list[int]:
    """Merge the neighbours whose union ranks lowest, the leftmost first, until none is left.

    Parts are a linked list by their starts, and merges wait in a heap, so a piece of n bytes
    takes n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    alive = [True] * size

    def offer(start: int) -> None:
        middle = after[start]
        if middle < size:
            rank = ranks.get(piece[start : after[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, middle, after[middle]))

    heap: list[tuple[int, int, int, int]] = []
    for start in range(size - 1):
        offer(start)
    while heap:
        _, start, middle, end = heapq.heappop(heap)
        if not (alive[start] and after[start] == middle and middle < size and after[middle] == end):
            continue
        alive[middle] = False
        after[start] = end
        if end < size:
            before[end] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    out, start = [], 0
    while start < size:
        out.append(ranks[piece[start : after[start]]])
        start = after[start]
    return out


class Encoder:
    """Ids of pieces; short pieces that come again in a task are looked up."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.memo = ranks, {}

    def ids(self, piece: str) -> list[int]:
        known = self.memo.get(piece)
        if known is None:
            known = encode(piece.encode(), self.ranks)
            if len(piece) <= MEMO_BYTES and len(self.memo) < MEMO_PIECES:
                self.memo[piece] = known
        return known

    def parts(self, piece: str, limit: int) -> list[tuple[str, int]]:
        """The piece in parts of at most ``limit`` tokens each, halved where it has more."""
        count = len(self.ids(piece))
        if count <= limit or len(piece) < 2:
            return [(piece, count)]
        half = len(piece) // 2
        return self.parts(piece[:half], limit) + self.parts(piece[half:], limit)

    def chunks(self, pieces: list[str], limit: int) -> list[tuple[str, int]]:
        """(text, tokens): as many whole pieces as fit in each chunk."""
        out: list[tuple[str, int]] = []
        held: list[str] = []
        total = 0
        for piece in pieces:
            for part, count in self.parts(piece, limit):
                if held and total + count > limit:
                    out.append(("".join(held), total))
                    held, total = [], 0
                held.append(part)
                total += count
        if held:
            out.append(("".join(held), total))
        return out
