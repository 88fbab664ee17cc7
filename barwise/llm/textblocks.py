"""Words and word shingles of Arrow text columns, vectorised in numpy.

The functions work on the UTF-8 bytes of a batch directly (no Python string
per word).  A *unit* is one document, or one line of a document.  Words are
the runs of bytes outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z; no
multi-byte UTF-8 character holds such a byte.  Rows are handled in blocks of
about ``BLOCK`` bytes, so memory does not grow with the batch; a longer text
makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
U64 = np.uint64
MULT = U64(0x9E3779B97F4A7C15)
MULT_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = U64(0xD6E8FEB86659FD93)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * STEP)[LOWER]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, U64)
    up = np.concatenate([one, np.cumprod(np.full(n, MULT, U64))])
    down = np.concatenate([one, np.cumprod(np.full(n, MULT_INV, U64))])
    return up, down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    size = BLOCK
    while size < n:
        size *= 2
    return _powers(size)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a text column; a null row is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]: ends[-1]], ends - ends[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes each, or of one row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def split_lines(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line units of the rows that begin at ``starts``: (unit starts, row, line number)."""
    after = np.flatnonzero(data == 10) + 1
    row_of = np.searchsorted(starts, after - 1, "right") - 1
    rows = np.arange(len(starts))
    first = rows + np.searchsorted(row_of, rows)
    begin, row = np.empty((2, len(starts) + len(after)), np.int64)
    at = np.arange(len(after)) + row_of + 1
    begin[first], begin[at] = starts, after
    row[first], row[at] = rows, row_of
    return begin, row, np.arange(len(row)) - first[row]


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; units begin at ``starts``."""
    n = len(data)
    body = (data != 0x20) & (data - np.uint8(0x09) > 0x04)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    edge[n] = True
    begin = body.copy()
    begin[1:] &= ~body[:-1] | edge[1:n]
    end = body.copy()
    end[:-1] &= ~body[1:] | edge[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes after lower-casing A-Z."""
    n = len(data)
    up, down = powers(n)
    total = np.zeros(n + 1, U64)
    value = BYTE_VALUE.take(data, mode="clip")
    value *= up[:n]
    np.cumsum(value, out=total[1:])
    value = total[last]
    value -= total[first]
    value *= down[first]
    return mix(value + (last - first).astype(U64) * STEP)


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit index, 64-bit hash) of every word; units begin at ``starts``."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    first, last = word_spans(data, starts)
    held = np.diff(np.searchsorted(first, starts), append=len(first))
    return np.repeat(np.arange(len(starts)), held), span_hashes(data, first, last)


def shingles(unit: np.ndarray, word: np.ndarray, units: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit index, hash) of the k-word shingles, repeats included.

    A unit of fewer than k words, but not none, has its whole word sequence
    as its one shingle.
    """
    n = len(word)
    if n == 0:
        return unit, word
    count = np.bincount(unit, minlength=units)
    parts_u, parts_h = [], []
    if n >= k:
        whole = unit[: n - k + 1] == unit[k - 1:]
        at = np.flatnonzero(whole)
        h = word[at]
        for j in range(1, k):
            h = h * STEP + word[at + j]
        parts_u.append(unit[at])
        parts_h.append(mix(h + U64(k)))
    first = np.cumsum(count) - count
    for m in range(1, k):
        short = np.flatnonzero(count == m)
        if len(short):
            h = word[first[short]]
            for j in range(1, m):
                h = h * STEP + word[first[short] + j]
            parts_u.append(short)
            parts_h.append(mix(h + U64(m)))
    return np.concatenate(parts_u), np.concatenate(parts_h)


def distinct(unit: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (unit, value) pairs, by unit and then value.

    Units of about one size are sorted together as the rows of a matrix."""
    if len(unit) == 0:
        return unit, value
    if (unit[1:] < unit[:-1]).any():
        order = np.argsort(unit, kind="stable")
        unit, value = unit[order], value[order]
    start = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    count = np.diff(np.r_[start, len(unit)])
    out = np.empty_like(value)
    level = np.ceil(np.log2(count)).astype(np.int64)
    for k in np.unique(level):
        rows = np.flatnonzero(level == k)
        at = start[rows, None] + np.arange(1 << int(k))
        inside = at < (start + count)[rows, None]
        part = np.where(inside, value[np.minimum(at, len(value) - 1)], np.iinfo(U64).max)
        part.sort(axis=1)
        out[at[inside]] = part[inside]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (out[1:] != out[:-1])
    return unit[new], out[new]


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of consecutive, non-empty segments."""
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, U64)
