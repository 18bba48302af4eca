"""A trie over token sequences, in arrays, and its longest matches in batches of texts.

It runs inside tasks. The arrays travel as a broadcast; the code is pickled by value, so
workers need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = -1


class Arrays(NamedTuple):
    """``moves`` are node * width + token, sorted, and lead to ``nodes``; ``ends`` gives the
    number of the sequence that ends at a node, or NONE."""

    width: int
    moves: np.ndarray
    nodes: np.ndarray
    ends: np.ndarray


def build(sequences: Iterable[Sequence[str]]) -> tuple[dict[str, int], tuple]:
    """(numbers of tokens, arrays) of distinct sequences, numbered in their order."""
    vocabulary: dict[str, int] = {}
    children: dict[tuple[int, int], int] = {}
    ends = [NONE]
    for number, sequence in enumerate(sequences):
        node = 0
        for token in sequence:
            at = (node, vocabulary.setdefault(token, len(vocabulary)))
            if at not in children:
                children[at] = len(ends)
                ends.append(NONE)
            node = children[at]
        ends[node] = number
    width = max(1, len(vocabulary))
    moves = np.array([node * width + token for node, token in children], np.int64)
    order = np.argsort(moves)
    nodes = np.array(list(children.values()), np.int64)
    return vocabulary, tuple(Arrays(width, moves[order], nodes[order], np.array(ends, np.int64)))


def longest_matches(tokens: np.ndarray, arrays: tuple) -> list[tuple[int, int, int]]:
    """(place, tokens, sequence) from left to right, the longest at each place, without overlap.

    ``tokens`` are numbers of the vocabulary; NONE stands for any other token and for the gap
    between two texts. All places go down the trie together, a level at a time.
    """
    width, moves, nodes, ends = Arrays(*arrays)
    if len(moves) == 0 or len(tokens) == 0:
        return []
    padded = np.append(tokens, NONE)
    size = np.zeros(len(tokens), np.int64)
    found = np.full(len(tokens), NONE, np.int64)
    places = np.flatnonzero(tokens != NONE)
    at = np.zeros(len(places), np.int64)
    depth = 0
    while len(places):
        token = padded[places + depth]
        wanted = at * width + token
        where = np.minimum(np.searchsorted(moves, wanted), len(moves) - 1)
        onward = (token != NONE) & (moves[where] == wanted)
        places, at = places[onward], nodes[where[onward]]
        depth += 1
        whole = ends[at] != NONE
        size[places[whole]] = depth
        found[places[whole]] = ends[at[whole]]
        going = places + depth < len(tokens)
        places, at = places[going], at[going]
    out, free = [], 0
    for place in np.flatnonzero(size).tolist():
        if place >= free:
            out.append((place, int(size[place]), int(found[place])))
            free = place + out[-1][1]
    return out
