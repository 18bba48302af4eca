"""CRC-32 of many spans of a byte array at once, with numpy.

A CRC is linear over XOR: what one byte adds to it depends on the byte and on its
distance from the end of the span alone. Those contributions stand in a table, one row
per distance; a span's CRC is the XOR of the contributions of its bytes and of a
constant for its length. Spans longer than the table are cut in blocks: each block's
sum comes from the table, and the blocks are folded one after another, moving the sum
so far on by the length of a block.

This runs inside tasks. The module is pickled by value, so workers need no copy of it.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the polynomial of CRC-32, lowest bit first.
POLYNOMIAL = 0xEDB88320
BLOCK = 64
PIECE_BYTES = 1 << 19


def _byte_table() -> np.ndarray:
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(POLYNOMIAL), rows >> 1).astype(np.uint32)
    return rows


class PositionTable:
    """``places[d, b]``: what byte b adds at d bytes from the end; ``lengths[n]``: the
    state that the initial value leaves after n bytes; ``onward``: the state after a
    whole block of zero bytes, by the four bytes of the state before."""

    def __init__(self, block: int = BLOCK):
        step = _byte_table()

        def moved(state: np.ndarray) -> np.ndarray:
            return (step[state & 255] ^ (state >> 8)).astype(np.uint32)

        self.block = block
        self.places = np.empty((block, 256), np.uint32)
        self.places[0] = step
        self.lengths = np.empty(block + 1, np.uint32)
        self.lengths[0] = 0xFFFFFFFF
        for at in range(1, block):
            self.places[at] = moved(self.places[at - 1])
        for at in range(block):
            self.lengths[at + 1] = moved(self.lengths[at : at + 1])[0]
        self.onward = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
        for _ in range(block):
            self.onward = moved(self.onward)

    def __reduce__(self):
        return PositionTable, (self.block,)

    def _sums(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """XOR of the contributions of each piece; no piece is empty or over a block."""
        out = np.empty(len(starts), np.uint32)
        ends = np.cumsum(sizes)
        low = 0
        while low < len(starts):
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
            heads = np.concatenate([[0], ends[low : high - 1] - before])
            size = sizes[low:high]
            inside = np.arange(int(ends[high - 1]) - before) - np.repeat(heads, size)
            places = np.repeat(starts[low:high], size) + inside
            distance = np.repeat(size - 1, size) - inside
            parts = self.places.ravel()[distance * 256 + data[places]]
            out[low:high] = np.bitwise_xor.reduceat(parts, heads)
            low = high
        return out

    def crc32(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The CRC-32 of the bytes from each start to before each end."""
        if len(starts) == 0:
            return np.zeros(0, np.uint32)
        sizes = ends - starts
        blocks = np.maximum(1, -(-sizes // self.block))
        head = sizes - (blocks - 1) * self.block
        filled = np.maximum(head, 1)
        state = self._sums(data, np.minimum(starts, max(len(data) - 1, 0)), filled)
        state = np.where(sizes > 0, state, 0).astype(np.uint32) ^ self.lengths[head]
        longer = np.flatnonzero(blocks > 1)
        done = 1
        while len(longer):
            at = starts[longer] + head[longer] + (done - 1) * self.block
            old = state[longer]
            moved = self.onward[0][old & 255] ^ self.onward[1][(old >> 8) & 255]
            moved ^= self.onward[2][(old >> 16) & 255] ^ self.onward[3][old >> 24]
            state[longer] = moved ^ self._sums(data, at, np.full(len(at), self.block))
            done += 1
            longer = longer[blocks[longer] > done]
        return state ^ np.uint32(0xFFFFFFFF)
