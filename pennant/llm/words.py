"""Whole texts as arrays: word and shingle hashes of an Arrow batch, without a Python object per word.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``, A-Z in lower case. Words and shingles stand as 64-bit
hashes: two different ones of one comparison meet with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 2 << 20
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


EXACT = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
_TABLE = EXACT.copy()
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _TABLE[_c + 32]
_STEPS = [U(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = U(1)
    return np.cumprod(out, dtype=np.uint64)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least n places; those for usual chunks are kept."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = -(-n // (1 << 18)) << 18
        made = _powers(_BASE, size), _powers(_INVERSE, size)
        if size > 2 * CHUNK_BYTES:
            return made
        _POWERS[:] = [made]
    return _POWERS[0]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of len + 1): null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``most`` bytes; a longer text is one alone."""
    raw, at = texts(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield row, end, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    gap = _SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True  # words end with their text
    before = np.empty(len(raw), bool)
    before[0], before[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = True, gap[1:]
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def prefix_sums(raw: np.ndarray, table: np.ndarray = _TABLE) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which ``(p[end] - p[start]) * inverse[start]`` is the hash of any byte range."""
    power, inverse = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * power[: len(raw)], dtype=np.uint64, out=sums[1:])
    return sums, inverse


def hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per byte range, A-Z as a-z."""
    sums, inverse = prefix_sums(raw)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(raw: np.ndarray, at: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its k-word shingles; fewer words are one shingle, no word is none."""
    starts, ends, row = spans(raw, at)
    word = hashed(raw, starts, ends)
    first = np.searchsorted(row, np.arange(len(at)))
    n = len(word) - k + 1
    if n > 0:
        joined = word[:n] * _STEPS[0]
        for j in range(1, k):
            joined = joined + word[j : j + n] * _STEPS[j]
        joined = mix(joined + U(k))
    out = []
    for i in range(len(at) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            found = np.sort(joined[a : b - k + 1])
            keep = np.empty(len(found), bool)
            keep[0], keep[1:] = True, found[1:] != found[:-1]
            out.append(found[keep])
        elif b > a:
            few = np.asarray([_STEPS[j] for j in range(b - a)], np.uint64)
            out.append(mix(np.asarray([(word[a:b] * few).sum(dtype=np.uint64) + U(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
