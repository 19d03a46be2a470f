"""Word and shingle hashes of whole Arrow batches, vectorised over bytes.

Texts are read as UTF-8 with A-Z lower-cased; words are runs of bytes other
than space and 0x09-0x0D. Hashes have 64 bits and do not depend on the process,
so equal texts hash alike on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


# What a worker has computed once.
_kept: dict[object, object] = {}


def _byte_values() -> np.ndarray:
    """A random value for each byte, the same for A-Z and a-z."""
    if "bytes" not in _kept:
        byte = np.arange(256, dtype=_U64)
        byte[65:91] += _U64(32)
        _kept["bytes"] = mix(byte * _BASE + _U64(1))
    return _kept["bytes"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if n > _SEGMENT or "powers" not in _kept:
        out = []
        for base in (_BASE, _U64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(max(n, _SEGMENT), base, _U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n > _SEGMENT:
            return out[0], out[1]
        _kept["powers"] = tuple(out)
    return _kept["powers"]


def _segment_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each ``buf[start:end]``, from one running sum."""
    up, down = _powers(len(buf))
    total = np.empty(len(buf) + 1, _U64)
    total[0] = 0
    np.cumsum(_byte_values()[buf] * up[: len(buf)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U64) * _BASE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_limits(
    buf: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words do not cross the row offsets ``at``."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~space[buf]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    row_start = at[:-1][at[:-1] < at[1:]]
    begins[row_start] = word[row_start]
    start = np.flatnonzero(begins)
    ends = np.zeros(len(buf) + 1, bool)
    ends[1:-1] = word[:-1] & ~word[1:]
    ends[row_start] |= np.where(row_start > 0, word[row_start - 1], False)
    ends[-1] = word[-1]
    return start, np.flatnonzero(ends)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the given words, which are in order."""
    hashes = np.empty(len(start), _U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _SEGMENT, "right")))
        lo, hi = start[i], end[j - 1]
        hashes[i:j] = _segment_hashes(buf[lo:hi], start[i:j] - lo, end[i:j] - lo)
        i = j
    return hashes


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:end]`` of hashes, from one running sum."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, _U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U64) * _BASE)


def batch_words(
    buf: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 offsets of the rows in them."""
    start, end = word_limits(buf, at, space)
    return word_hashes(buf, start, end), np.searchsorted(start, at)


def _places(width: int) -> np.ndarray:
    """An odd multiplier for each place of a shingle."""
    return mix(np.arange(1, width + 1, dtype=_U64)) | _U64(1)


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    out = np.zeros(max(0, len(words) - width + 1), _U64)
    for k, factor in enumerate(_places(width)):
        out += words[k : len(out) + k] * factor
    return mix(out + _U64(width))


def batch_shingles(words: np.ndarray, at: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each row the hashes of its runs of ``width`` words, in order, repeats included.

    Fewer words than ``width`` form one shingle; no word, none.
    """
    runs = _runs(words, width)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            yield runs[a : b - width + 1]
        else:
            yield _runs(words[a:b], b - a) if b > a else words[a:b]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for lo, hi in chunks(column):
        words, at = batch_words(*text_bytes(column.slice(lo, hi - lo)))
        yield from map(distinct, batch_shingles(words, at, width))


def chunks(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, one row at least."""
    size = np.cumsum(np.diff(text_bytes(column)[1]))
    lo = 0
    while lo < len(column):
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + most, "right")))
        yield lo, hi
        lo = hi
