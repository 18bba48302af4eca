"""Arrow batches of lists, in slices of bounded length, for functions that run inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_ITEMS = 500_000


def sizes(lists: pa.Array) -> np.ndarray:
    """Elements of each list; a NULL has none."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def chars(lists: pa.Array) -> np.ndarray:
    """Bytes of all strings of each list."""
    total = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False)))
    ends = np.cumsum(sizes(lists))
    return (total[ends] - total[ends - sizes(lists)]).astype(np.int64)


def slices(
    lists: pa.Array, items: int = SLICE_ITEMS, weigh: Callable[[pa.Array], np.ndarray] = sizes
) -> Iterator[pa.Array]:
    """The lists in order, as many at a time as have so many elements together, one at least.

    A batch has a fixed number of rows, whatever their length; what a task holds beside the
    batch is held for one slice.
    """
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    ends = np.cumsum(weigh(lists) + 1)
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + items, "right")))
        yield lists.slice(start, end - start)
        start = end


def listed(values: pa.Array, counts: np.ndarray, known: np.ndarray) -> pa.Array:
    """Lists of so many of the values each; NULL where not known, which must have none."""
    offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(~known))
