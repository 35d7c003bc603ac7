"""Words of Arrow string columns as numpy arrays.

A batch is worked through in slices of about ``SLICE`` bytes (a longer text
is a slice of its own), so memory stays near forty times a slice whatever
the batch holds. Words are hashed all at once by prefix sums of a
polynomial: the hash of bytes [s, e) is (P[e] - P[s]) / B**s modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PLAIN = np.arange(256, dtype=np.uint8)
#: Separators of the word contracts: blank and \t to \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Everything that is no ASCII letter or digit and no part of a longer character.
PUNCT = np.ones(256, bool)
PUNCT[48:58] = PUNCT[65:91] = PUNCT[97:123] = PUNCT[128:] = False

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        a = np.full(max(n, SLICE), base, U)
        a[0] = 1
        have = np.multiply.accumulate(a)
        if n <= 4 * SLICE:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds): ``bounds`` has the rows' limits in the
    bytes; null texts are empty."""
    if len(column) == 0:
        return
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, data[bounds[at]:bounds[end]], bounds[at:end + 1] - bounds[at]
        at = end


def spans(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; no word crosses a row's limits."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    gap = separator[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[bounds[:-1][bounds[:-1] < n]] = True
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def prefix(data: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
    """Prefix sums for :func:`hashed`, bytes mapped by ``table``."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum((table[data].astype(U) + U(1)) * _power("up", _BASE, len(data)), out=out[1:])
    return out


def hashed(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every [start, end)."""
    inverse = _power("down", _INVERSE, max(len(sums), 1))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U))


_STEP = U(0xD6E8FEB86659FD93)


def grams(words: np.ndarray, row: np.ndarray, n: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``n`` words inside a row, in order."""
    if len(words) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    m = len(words) - n + 1
    acc = words[:m].copy()
    for k in range(1, n):
        acc = acc * _STEP + words[k:k + m]
    inside = row[:m] == row[n - 1:]
    return mix(acc[inside] + U(n)), row[:m][inside]
