"""HTML extraction by a tree-structured graphical model.

Every node of a page's block tree (:mod:`barwise.llm.dom`) is main text or
not.  A node's potential comes from weights of its features (tag, class and id
words, text length, share of linked text); an edge's from weights of the
child's features for each pair of parent and child labels.  Sum-product
messages upward and downward give every text run's exact marginal; runs above
one half are the main text.  Weights are trained by gradient ascent on the
likelihood of labelled pages (:mod:`barwise.llm.html_pages`), whose expected
counts come from the same messages.  Pages are handled in batches, level by
level, in numpy.

Results for odd input: a null or empty page, and one without main text, has
the empty text.  Pages may be cut off anywhere.  Rows repeat as given; a null
page_id or url stays null.  An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm import html_pages
from barwise.llm.dom import Node, parse

BITS = 10
TRAIN_PAGES, SEED, STEPS, RATE, DECAY = 600, 5, 120, 0.15, 2e-4
#: Pages and characters of one batch of messages.
PAGES, CHARS = 256, 1 << 21


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << BITS) - 1)


@lru_cache(maxsize=1 << 14)
def _tag_features(tag: str, names: tuple[str, ...]) -> tuple[int, ...]:
    return (_bucket("any"), _bucket("tag " + tag), *(_bucket("name " + x) for x in names))


@lru_cache(maxsize=1 << 12)
def _run_features(parent: str, length: int, linked: int) -> tuple[int, ...]:
    return (_bucket("any"), _bucket("in " + parent), _bucket(f"length {length}"), _bucket(f"linked {linked}"), _bucket(f"in {parent} linked {linked}"))


def node_features(nodes: list[Node]) -> list[tuple[int, ...]]:
    return [_tag_features(n.tag, n.names) if n.text is None else
            _run_features(nodes[n.parent].tag, len(n.text).bit_length() // 2, int(2 * n.linked + 0.5)) for n in nodes]


class Forest:
    """The trees of a batch of pages: parents, levels and sparse features."""

    def __init__(self, pages: list[list[Node]]):
        sizes = [len(p) for p in pages]
        begin = np.repeat(np.cumsum([0, *sizes])[:-1], sizes)
        parent = np.array([n.parent for p in pages for n in p])
        self.parent = np.where(parent >= 0, parent + begin, -1)
        depth = np.array([n.depth for p in pages for n in p])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        features = [f for p in pages for f in node_features(p)]
        self.feature = np.fromiter((x for f in features for x in f), np.int64)
        self.node = np.repeat(np.arange(len(features)), [len(f) for f in features])
        self.first = np.flatnonzero(np.r_[True, self.node[1:] != self.node[:-1]])

    def marginals(self, own: np.ndarray, edge: np.ndarray):
        """P(label) of each node, P(parent's, own label) of each edge, and the log normaliser.

        ``own`` (features, 2) and ``edge`` (features, 2, 2: parent's, own label)."""
        alone = np.add.reduceat(own[self.feature], self.first)
        pair = np.add.reduceat(edge[self.feature], self.first)
        below = alone.copy()  # potential with all messages from children
        up = np.zeros_like(alone)  # message to the parent
        for level in self.levels[:0:-1]:
            up[level] = np.logaddexp.reduce(pair[level] + below[level][:, None, :], axis=2)
            np.add.at(below, self.parent[level], up[level])
        belief = below.copy()
        both = np.zeros((len(alone), 2, 2))
        for level in self.levels[1:]:
            rest = belief[self.parent[level]] - up[level]
            joint = rest[:, :, None] + pair[level] + below[level][:, None, :]
            belief[level] = np.logaddexp.reduce(joint, axis=1)
            both[level] = np.exp(joint - np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None])
        total = np.logaddexp.reduce(belief, axis=1)
        return np.exp(belief - total[:, None]), both, float(total[self.levels[0]].sum())


@lru_cache(maxsize=1)
def train() -> tuple[np.ndarray, np.ndarray]:
    """Node and edge weights fitted to the labelled pages."""
    labelled = html_pages.pages(TRAIN_PAGES, SEED)
    forest = Forest([nodes for nodes, _ in labelled])
    label = np.array([y for _, labels in labelled for y in labels])
    size = 1 << BITS
    child = forest.parent >= 0
    truth_own, truth_edge = np.eye(2)[label], np.zeros((len(label), 2, 2))
    truth_edge[np.flatnonzero(child), label[forest.parent[child]], label[child]] = 1

    def counts(own: np.ndarray, edge: np.ndarray):
        a, b = np.zeros((size, 2)), np.zeros((size, 2, 2))
        np.add.at(a, forest.feature, own[forest.node])
        np.add.at(b, forest.feature, edge[forest.node])
        return a, b

    seen = counts(truth_own, truth_edge)
    weights = [np.zeros((size, 2)), np.zeros((size, 2, 2))]
    state = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for step in range(1, STEPS + 1):
        p, both, _ = forest.marginals(*weights)
        for w, a, b, (m, v) in zip(weights, seen, counts(p, both), state):
            g = (a - b) / len(labelled) - DECAY * w
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return weights[0], weights[1]


def main_texts(pages: list[str], weights: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The main text of every page: its runs joined by two line ends."""
    out: list[str] = []
    trees = [parse(p) for p in pages]
    p = Forest(trees).marginals(*weights)[0][:, 1]
    at = 0
    for nodes in trees:
        out.append("\n\n".join(n.text for n, x in zip(nodes, p[at: at + len(nodes)]) if n.text is not None and x > 0.5))
        at += len(nodes)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(train())

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            html, out, a, size = [h or "" for h in batch["html"]], [], 0, 0
            for i, h in enumerate(html):
                size += len(h)
                if size >= CHARS or i + 1 - a == PAGES or i + 1 == len(html):
                    out += main_texts(html[a: i + 1], shared.value)
                    a, size = i + 1, 0
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out, "n_chars": [len(x) for x in out]})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(rows, "page_id long, url string, text string, n_chars long")
