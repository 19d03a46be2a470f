"""Lists and texts of Arrow columns as starts and values, for functions that run in tasks.

They are sent by value, so executors need no copy of the library.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def flat_lists(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each list starts among all values, with the end behind it, and the values; null lists are empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), lists.flatten()


def kept_values(starts: np.ndarray, flat: pa.Array, keep: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The same lists with the marked values only."""
    before = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
    return before[starts], flat.filter(pa.array(keep, pa.bool_()))


def text_tokens(
    texts: pa.Array, marker: bytes, mark: int, slice_bytes: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row behind, starts, tokens`` for slices of a binary column: bytes as ids, each
    occurrence of ``marker`` (leftmost first, never over the end of a text) as the id ``mark``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + slice_bytes, "right")))
        data = b"".join(t for t in texts.slice(lo, hi - lo).to_pylist() if t)
        limit = np.concatenate(([0], ends[lo:hi] - before))
        found = []
        for a, b in zip(limit[:-1].tolist(), limit[1:].tolist()):
            while (a := data.find(marker, a, b)) >= 0:
                found.append(a)
                a += len(marker)
        tokens, keep = np.frombuffer(data, np.uint8).astype(np.int32), np.ones(len(data), bool)
        spots = np.array(found, np.int64)
        tokens[spots] = mark
        keep[(spots[:, None] + np.arange(1, len(marker))).ravel()] = False
        yield lo, hi, np.concatenate(([0], np.cumsum(keep)))[limit], tokens[keep]
        lo = hi


def window_values(
    start: np.ndarray, tokens: np.ndarray, maxlen: int, pad_id: int, targets: bool
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Windows per sequence, and the inputs (and targets) of all windows one after the other."""
    sizes = np.diff(start)
    counts = -(-sizes // maxlen)
    first = np.concatenate(([0], np.cumsum(counts)[:-1])) * maxlen
    place = np.arange(len(tokens)) + np.repeat(first - start[:-1], sizes)
    values = [np.full(int(counts.sum()) * maxlen, pad_id, np.int32)]
    values[0][place] = tokens
    if targets:
        follows = np.ones(len(tokens), bool)
        follows[start[:-1][sizes > 0]] = False
        values.append(np.full(len(values[0]), pad_id, np.int32))
        values[1][place[follows] - 1] = tokens[follows]
    return counts, values
