"""Quality classifier: a byte-level convolutional network in numpy.

The text's UTF-8 bytes are cut into chunks of 256 bytes that overlap by half
and cover all of it.  Learned filters (8 bytes wide) run over every position
and are max-pooled per chunk; a second channel of each chunk is the largest
share of bytes that equal the byte at one distance (2 to 24) before, which
shows repeated words.  Mean and maximum of the chunk vectors over the document
go through one logistic unit.

Training is Adam on a bounded sample: the labelled rows outside the held-out
fold, of texts up to ``TRAIN_CHARS`` characters, thinned by a hash of doc_id
to about ``TRAIN_ROWS`` rows.  It runs on the driver, which never holds more
than that sample.  Scoring runs over all rows in the tasks, in blocks of
positions, so memory does not grow with a text.

Results for odd input: null and empty texts are scored like a text without a
chunk (the unit's bias).  A doc_id with several labels counts once for each
distinct one.  Without labels of both kinds the score is the share of label 1,
or 0.5 without any label.  Repeated rows get equal results.  An empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS, WIDTH, HALF = 16, 8, 128
LAGS = range(2, 25)
GAP = max(LAGS)  # zero bytes at least after every text
TRAIN_ROWS, TRAIN_CHARS, EPOCHS, BATCH, RATE, SEED = 3000, 20_000, 8, 48, 0.01, 17
SEGMENT = 1 << 15
BLOCK = 1 << 20


@dataclass
class Net:
    """Filter tables (width, byte, filter), their biases, the unit's weights and bias."""

    table: np.ndarray
    shift: np.ndarray
    unit: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        x, _ = features(self, Layout(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.unit + self.bias, -30, 30)))


class Layout:
    """Texts laid out in one byte array, each padded with zeros to whole half-chunks."""

    def __init__(self, texts: list[bytes]):
        halves = np.array([-(-(len(t) + GAP) // HALF) if t else 0 for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(t.ljust(h * HALF, b"\0") for t, h in zip(texts, halves)), np.uint8)
        chunks = np.where(halves > 0, np.maximum(halves - 1, 1), 0)
        self.rows = np.flatnonzero(chunks)
        self.count = len(texts)
        self.chunks = chunks[self.rows]
        self.begin = np.cumsum(self.chunks) - self.chunks
        first_half = (np.cumsum(halves) - halves)[self.rows]
        inside = np.arange(self.chunks.sum()) - np.repeat(self.begin, self.chunks)
        self.one = np.repeat(first_half, self.chunks) + inside
        self.two = self.one + np.repeat(halves[self.rows] > 1, self.chunks)


def _convolved(net: Net, data: np.ndarray, a: int, b: int) -> np.ndarray:
    """Filter outputs (half-chunk, position, filter) of the positions [a, b).

    A filter ends at its position; the zeros after every text keep it from
    reaching into the text before."""
    window = data[max(0, a - WIDTH + 1): b]
    window = np.concatenate([np.zeros(b - a + WIDTH - 1 - len(window), np.uint8), window])
    out = np.take(net.table[0], window[: b - a], axis=0)
    for j in range(1, WIDTH):
        out += np.take(net.table[j], window[j: j + b - a], axis=0)
    return out.reshape(-1, HALF, FILTERS)


def _repeats(data: np.ndarray) -> np.ndarray:
    """The repeat channel of every half-chunk."""
    best = np.zeros(len(data) // HALF, np.int64)
    for lag in LAGS:
        same = np.zeros(len(data), bool)
        same[lag:] = (data[lag:] == data[:-lag]) & (data[lag:] != 0)
        best = np.maximum(best, same.reshape(-1, HALF).sum(axis=1))
    return best / HALF


def features(net: Net, lay: Layout, places: bool = False):
    """(texts, 2 * (filters + 1)) pooled features, and what training needs."""
    n = len(lay.data)
    top, where = [], []
    for a in range(0, n, SEGMENT):
        out = _convolved(net, lay.data, a, min(a + SEGMENT, n))
        if places:
            at = out.argmax(axis=1)
            where.append(at + (a + HALF * np.arange(len(at)))[:, None])
            top.append(np.take_along_axis(out, at[:, None], 1)[:, 0])
        else:
            top.append(out.max(axis=1))
    x = np.zeros((lay.count, 2 * (FILTERS + 1)))
    if not n:
        return x, None
    top, repeat = np.concatenate(top), _repeats(lay.data)
    raw = np.maximum(top[lay.one], top[lay.two]) + net.shift
    chunk = np.concatenate([np.maximum(raw, 0), np.maximum(repeat[lay.one], repeat[lay.two])[:, None]], axis=1)
    x[lay.rows, : FILTERS + 1] = np.add.reduceat(chunk, lay.begin) / lay.chunks[:, None]
    x[lay.rows, FILTERS + 1:] = np.maximum.reduceat(chunk, lay.begin)
    return x, (np.concatenate(where), top, chunk) if places else None


def _gradients(net: Net, lay: Layout, x: np.ndarray, kept, slope: np.ndarray):
    """Gradients of the tables and shifts, given the loss's slope per text."""
    where, top, chunk = kept
    of = np.repeat(np.arange(len(lay.rows)), lay.chunks)
    d = slope[lay.rows][of, None]
    from_mean = d * net.unit[None, :FILTERS] / lay.chunks[of, None]
    highest = chunk[:, :FILTERS] == x[lay.rows][of, FILTERS + 1: 2 * FILTERS + 1]
    from_max = d * net.unit[None, FILTERS + 1: 2 * FILTERS + 1] * highest / np.maximum(1, np.add.reduceat(highest, lay.begin)[of])
    g = np.where(chunk[:, :FILTERS] > 0, from_mean + from_max, 0)
    half = np.where(top[lay.one] >= top[lay.two], lay.one[:, None], lay.two[:, None])
    position = np.take_along_axis(where, half, 0)
    table = np.zeros_like(net.table)
    data = np.concatenate([np.zeros(WIDTH - 1, np.uint8), lay.data])
    column = np.broadcast_to(np.arange(FILTERS), position.shape)
    for j in range(WIDTH):
        np.add.at(table[j], (data[position + j], column), g)
    return table, g.sum(axis=0)


def train(texts: list[bytes], labels: np.ndarray) -> Net:
    """A network fitted to texts with labels 0 and 1."""
    rnd = np.random.default_rng(SEED)
    share = float(labels.mean()) if len(labels) else 0.5
    net = Net(rnd.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
              rnd.normal(0, 0.1, 2 * (FILTERS + 1)), 0.0)
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Net(net.table, net.shift, np.zeros_like(net.unit), float(np.log(share / (1 - share))))
    net.bias = float(np.log(share / (1 - share)))
    state = [[np.zeros_like(v, dtype=float), np.zeros_like(v, dtype=float)] for v in (net.table, net.shift, net.unit, np.zeros(1))]
    step = 0
    for epoch in range(EPOCHS):
        order = rnd.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            pick = order[a: a + BATCH]
            lay = Layout([texts[i] for i in pick])
            x, kept = features(net, lay, places=True)
            p = 1 / (1 + np.exp(-np.clip(x @ net.unit + net.bias, -30, 30)))
            slope = (p - labels[pick]) / len(pick)
            table, shift = _gradients(net, lay, x, kept, slope) if kept else (np.zeros_like(net.table), np.zeros(FILTERS))
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            moved = []
            for grad, (m, v) in zip((table, shift, x.T @ slope + 1e-4 * net.unit, np.array([slope.sum()])), state):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad ** 2
                moved.append(rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8))
            net.table -= moved[0].astype(np.float32)
            net.shift -= moved[1].astype(np.float32)
            net.unit -= moved[2]
            net.bias -= float(moved[3][0])
    return net


def fold(doc_id: str, folds: int, held_out: int):
    """Whether a row is held out; a null doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == held_out, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Net:
    """A network from the bounded sample of labelled rows outside the held-out fold."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)").where(~fold("doc_id", folds, held_out)).distinct())
    n = marked.count()
    share = min(1.0, TRAIN_ROWS / max(1, n))
    sample = marked.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= TRAIN_CHARS)
            .join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality").collect())
    rows = sorted(rows)
    return train([r.text.encode() for r in rows], np.array([r.quality for r in rows], float))


def score(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch["text"]]
            out, a, size = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BLOCK or i + 1 == len(texts):
                    out.append(shared.value.score(texts[a: i + 1]))
                    a, size = i + 1, 0
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(out) if out else np.zeros(0)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(rows, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels, folds, held_out)).select(
        "doc_id", fold("doc_id", folds, held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
