"""Hashes over the bytes of Arrow text columns, with numpy and without a Python string.

These run inside tasks, batch by batch. The module is pickled by value, so workers
need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """So many fixed pseudo-random 64-bit numbers."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed))


def powers(base: np.uint64, count: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PowerTable:
    """The powers of a base, grown on demand; pickled without the table."""

    def __init__(self, base: np.uint64):
        self.base, self.table = base, powers(base, 1)

    def upto(self, count: int) -> np.ndarray:
        if len(self.table) < count:
            self.table = powers(self.base, count)
        return self.table

    def __reduce__(self):
        return PowerTable, (self.base,)


BYTE_VALUES = numbers(11, 256)
BASE = np.uint64(0xD6E8FEB86659FD93)
FORWARD = PowerTable(BASE)
BACKWARD = PowerTable(np.uint64(pow(int(BASE), -1, 1 << 64)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULL counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)
    places = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), places
    first, last = int(places[0]), int(places[-1])
    return np.frombuffer(data, np.uint8)[first:last], places - first


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): a hash for each word, lower-cased A-Z, and for each text the place
    of its first word; the words of text i are ``hashes[bounds[i]:bounds[i + 1]]``."""
    solid = np.flatnonzero(~SPACES[data])
    if len(solid) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    head = np.empty(len(solid), bool)
    head[0] = True
    np.not_equal(solid[1:], solid[:-1] + 1, out=head[1:])
    # A text that starts right after the last byte of another starts a word as well.
    firsts = np.searchsorted(solid, offsets[:-1])
    firsts = firsts[firsts < len(solid)]
    head[firsts] = True
    starts = np.flatnonzero(head)
    lengths = np.diff(np.append(starts, len(solid)))
    within = np.arange(len(solid)) - np.repeat(starts, lengths)
    values = BYTE_VALUES[LOWER[data[solid]]] * FORWARD.upto(int(lengths.max()))[within]
    hashes = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(solid[starts], offsets).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; a text of fewer
    words has its whole sequence as one, a text without words none."""
    hashes, bounds = word_hashes(data, offsets)
    joined = hashes[: max(0, len(hashes) - size + 1)].copy()
    for step in range(1, size):
        joined = mix(joined) * BASE + hashes[step : step + len(joined)]
    joined = mix(joined)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low >= size:
            out.append(np.unique(joined[low : high - size + 1]))
        elif high > low:
            whole = hashes[low : low + 1]
            for step in range(low + 1, high):
                whole = mix(whole) * BASE + hashes[step : step + 1]
            out.append(mix(mix(whole) + np.uint64(high - low)))
        else:
            out.append(joined[:0])
    return out


class RollingHash:
    """Hashes of all substrings of a byte array, from one prefix sum modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * FORWARD.upto(len(data) + 1)[: len(data)], out=sums[1:])
        self.sums = sums
        self.back = BACKWARD.upto(len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of the bytes from each start to before each end."""
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def all(self, size: int) -> np.ndarray:
        """The hash at each place where so many bytes follow."""
        count = len(self.sums) - size
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:count]) * self.back[:count] + np.uint64(size))


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbours, by doubling the span looked at."""
    span = 1
    while 2 * span <= size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = size - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def pieces(offsets: np.ndarray, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first byte, end byte) of chunks; a very long text comes in
    pieces that share ``overlap`` bytes, so that memory is bounded by the chunk."""
    for low, high in chunks(offsets):
        first, last = int(offsets[low]), int(offsets[high])
        if last - first <= 4 * CHUNK_BYTES:
            yield low, high, first, last
        else:
            for at in range(first, max(first + 1, last - overlap), CHUNK_BYTES):
                yield low, high, at, min(last, at + CHUNK_BYTES + overlap)


# Tokens of letters and digits: every byte but ASCII signs and controls.
BREAKS = np.zeros(256, bool)
BREAKS[:128] = True
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
PREFIXES = (3, 4, 5, 6)


def token_features(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(features, bounds, starts, stops) of the lower-cased tokens of each text.

    A feature column holds one hash per token: of the token, then of its first bytes for
    each length in PREFIXES; 0 where a token is not longer than that.
    """
    solid = ~BREAKS[data]
    heads = solid.copy()
    heads[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    heads[inner] = solid[inner]
    starts = np.flatnonzero(heads)
    tails = solid.copy()
    tails[:-1] &= ~solid[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    tails[ends] = solid[ends]
    stops = np.flatnonzero(tails) + 1
    bounds = np.searchsorted(starts, offsets).astype(np.int64)
    rolling = RollingHash(LOWER[data])
    columns = [rolling.of(starts, stops)]
    for size in PREFIXES:
        long = stops - starts > size
        hashes = np.zeros(len(starts), np.uint64)
        hashes[long] = mix(rolling.of(starts[long], starts[long] + size) + np.uint64(size))
        columns.append(hashes)
    return columns, bounds, starts, stops
