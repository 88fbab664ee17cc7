"""Periodic run detection: stretches of words that repeat with one period.

A *run* is a stretch of consecutive words whose smallest period is q (words q
apart are identical), at least ``max(LEAST, REPEATS * q)`` long, that no
neighbouring word extends keeping period q.

Method: multi-scale minimizers.  A scale looks for the periods Q .. 3Q/2.  Its
k-grams are as long as its longest period, and the window minima of their
hashes (the minimizers) inside a run recur at exactly the period, since the
window fits into the run twice, one period apart.  As a k-gram covers a whole
period, the two are neighbours among the minimizers of one hash, so equal
neighbours at a distance of the scale seed every run; each seed is extended word
by word in both directions and its period is checked to be the smallest.
Periods under ``DIRECT`` are too short for that and are found by direct lag
scans.  Hashes only propose: every run is verified on the words.

Documents are handled in blocks of about a megabyte, as one sequence in which a
document ends with a word of its own; a longer document is a block alone.  Rows
need no shuffle.

Results for odd input: null and blank texts have no words and no run.  Every row
is judged by itself, so repeated rows get equal results and a null doc_id stays
null.  Extra columns are ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm import textblocks as tb

#: A run has at least this many words, and at least this many periods.
LEAST, REPEATS = 24, 3
#: Periods below this are found by direct lag scans.
DIRECT = 8
#: (start, length, period) in words.
Run = tuple[int, int, int]


def _windowed(x: np.ndarray, w: int, fold: Callable) -> np.ndarray:
    """``fold`` (minimum or maximum) of every window of ``w`` values, by doubling."""
    size = 1
    while 2 * size <= w:
        x = fold(x[:-size], x[size:])
        size *= 2
    return fold(x[: len(x) - (w - size)], x[w - size:]) if size < w else x


def minimizers(h: np.ndarray, w: int) -> np.ndarray:
    """Positions whose value is the least of some window of ``w`` values."""
    if len(h) < w:
        return np.zeros(0, np.int64)
    low = _windowed(h, w, np.minimum)
    pad = np.zeros(w - 1, h.dtype)
    return np.flatnonzero(_windowed(np.concatenate([pad, low, pad]), w, np.maximum) == h)


def _extended(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """[start, end) of the stretch around ``at`` in which words ``period`` apart are identical."""
    end, step = at, 64
    while True:
        stop = min(end + step, len(ids) - period)
        differs = np.flatnonzero(ids[end: stop] != ids[end + period: stop + period])
        if len(differs) or stop == len(ids) - period:
            end = end + int(differs[0]) if len(differs) else stop
            break
        end, step = stop, 2 * step
    start, step = at, 64
    while True:
        stop = max(0, start - step)
        differs = np.flatnonzero(ids[stop: start] != ids[stop + period: start + period])
        if len(differs) or stop == 0:
            start = stop + int(differs[-1]) + 1 if len(differs) else 0
            break
        start, step = stop, 2 * step
    return start, end + period


def _primitive(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether a run's period is its smallest; a smaller one would divide it."""
    left, f = period, 2
    while left > 1:
        if f * f > left:
            f = left
        if left % f == 0:
            q = period // f
            if np.array_equal(ids[start: start + period], ids[start + q: start + q + period]):
                return False
            while left % f == 0:
                left //= f
        f += 1
    return True


def _take(ids: np.ndarray, seeds: np.ndarray, period: int, out: list[Run]) -> None:
    """The runs of one period around ascending seeds."""
    done = -1
    for at in seeds.tolist():
        if at < done:
            continue
        start, end = _extended(ids, at, period)
        done = end - period
        if end - start >= max(LEAST, REPEATS * period) and _primitive(ids, start, period):
            out.append((start, end - start, period))


def _short(ids: np.ndarray, period: int) -> np.ndarray:
    """A seed in every run of a short period: a grid of places, each with its next few words."""
    step = (max(LEAST, REPEATS * period) - period) // 2
    at = np.arange(0, len(ids) - period - step + 1, step)
    for i in range(step):
        at = at[ids[at + i] == ids[at + i + period]]
    return at


def _seeds(value: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal neighbouring minimizers at a distance of ``low`` to ``high``; words come as hashes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    k, w = high, 2 * low - high + 1
    n = len(value)
    if n < k + w - 1:
        return none
    up, down = tb.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * up[:n], out=total[1:])
    h = tb.mix((total[k:] - total[:-k]) * down[: n - k + 1])
    at = minimizers(h, w)
    at = at[np.argsort(h[at], kind="stable")]
    distance = at[1:] - at[:-1]
    fits = (h[at[1:]] == h[at[:-1]]) & (distance >= low) & (distance <= high)
    return at[:-1][fits], distance[fits]


def runs(ids: np.ndarray, starts: np.ndarray) -> list[Run]:
    """All runs of the documents that begin at ``starts``, in the order of (start, period).

    ``ids`` holds non-negative word numbers; documents are kept apart by a word that occurs nowhere
    else after each of them, so no run crosses a border."""
    out: list[Run] = []
    for period in range(1, min(DIRECT, len(ids))):
        _take(ids, _short(ids, period), period, out)
    ends = np.r_[starts[1:], len(ids)]
    value = tb.mix(ids.astype(np.uint64))
    low = DIRECT
    origin = np.arange(len(starts))
    while True:
        # documents too short for a scale have no run of it
        long = ends[origin] - starts[origin] > REPEATS * low
        if not long.any():
            return sorted(out, key=lambda r: (r[0], r[2]))
        origin = origin[long]
        size = (ends - starts)[origin]
        first = np.cumsum(size) - size
        high = low + low // 2
        at, distance = _seeds(np.concatenate([value[starts[i]: ends[i]] for i in origin]), low, high)
        doc = np.searchsorted(first, at, "right") - 1
        at = at - first[doc] + starts[origin[doc]]
        for period in np.unique(distance).tolist():
            _take(ids, np.sort(at[distance == period]), period, out)
        low = high + 1


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The original word that each word of a document becomes, where the query plants a repeat."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def kept(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    out = np.ones(n, bool)
    for start, length, period in found:
        out[start + period: start + length] = False
    return out


def best(found: list[Run]) -> Run | None:
    """The run of the most periods; ties go to the smallest start, then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
TEXT_SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _documents(batches: Iterator[pa.RecordBatch], change: Callable | None) -> Iterator[tuple]:
    """(doc_id, words, its runs) of every row, a block of rows at a time."""
    for batch in batches:
        data, offsets = tb.utf8(batch.column(1))
        names = batch.column(0).to_pylist()
        for a, b in tb.blocks(offsets):
            texts = [data[offsets[i]: offsets[i + 1]].tobytes().split() for i in range(a, b)]
            number: dict[bytes, int] = {}
            parts, begin, at = [], [], 0
            for i, words in enumerate(texts):
                for w in set(words).difference(number):
                    number[w] = len(number)
                ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                place = change(names[a + i], len(words)) if change else None
                if place is not None:
                    ids = ids[place]
                    texts[i] = [words[j] for j in place.tolist()]
                parts += [ids, np.array([-1])]
                begin.append(at)
                at += len(words) + 1
            ids = np.concatenate(parts)
            borders = np.flatnonzero(ids < 0)
            ids[borders] = len(number) + np.arange(len(borders))
            begin = np.array(begin)
            own: dict[int, list[Run]] = {}
            for start, length, period in runs(ids, begin):
                doc = int(np.searchsorted(begin, start, "right")) - 1
                own.setdefault(doc, []).append((start - int(begin[doc]), length, period))
            yield [(names[a + i], words, own.get(i, [])) for i, words in enumerate(texts)]


def _collapsed(words: list[bytes], found: list[Run]) -> bytes:
    return b" ".join(words if not found else [words[i] for i in np.flatnonzero(kept(len(words), found)).tolist()])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, runs and collapsed (the kept words, joined by one space) of every row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for part in _documents(batches, None):
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _, _ in part], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for _, _, found in part], struct),
                 pa.array([_collapsed(words, found).decode() for _, words, found in part], pa.string())], ["doc_id", "runs", "collapsed"])

    return _rows(docs).mapInArrow(rows, TEXT_SCHEMA)


def report(docs: DataFrame, change: Callable | None = None) -> DataFrame:
    """Number of runs, the best one, and digests of all runs and of the collapsed text of every row.

    ``change(doc_id, n)``, if given, returns the original word's number for each of a document's n words
    (None: as they are)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _documents(batches, change):
            out = []
            for doc_id, words, found in part:
                top = best(found)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                out.append((doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(_collapsed(words, found)).hexdigest()))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             [f.split()[0] for f in SCHEMA.split(", ")])

    return _rows(docs).mapInArrow(rows, SCHEMA)
