"""Gradient-boosted trees grown best leaf first, from distributed histograms.

One *run* trains several models (walk-forward folds and the final fit) over one
stored table of binned rows.  A round adds one tree to every model that still
goes on; a level of those trees is one pass over the table: tasks add up
gradients, hessians and counts per (model, leaf, feature, bin), and the sums
give the splits of all models at once.  Of two sisters only the smaller is
summed; the other is the parent less it.

* Sums are of whole numbers (gradients in steps of 2**-24), so they do not
  depend on the partitioning, and a model trained alone equals the same model
  trained beside others.
* Best leaf first: a leaf's split does not depend on the order of growth, so
  all leaves down to the depth limit are split first and the splits are then
  taken by falling gain until the tree has its number of leaves.
* Missing values have a bin of their own in every feature, and every split sends
  them to the side that gains more (a tie: to the larger values).  "Missing
  or not" is itself a split.
* Categories are ordered by gradient over smoothed hessian at each leaf; any
  prefix of that order may go left.
* Margins are a column of the table.  Trees since the last rewrite are added
  on the fly; every ``KEEP`` rounds the table is written anew, so a pass costs the
  same in round 900 as in round 1 and boosting goes on from where it is.
* Early stopping is per model, by the loss of its validation rows, which comes
  with the next round's first pass; nothing is fitted twice.

What reaches the driver is one array of (models x leaves x bins) sums a pass,
bounded by the parameters, whatever the number of rows and of partitions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from barwise.session import forget, written

#: Gradients and losses are summed in these steps.
SCALE = float(1 << 24)
#: Rounds after which margins are written into the table.
KEEP = 10
#: Rows of one partition of the table, if there are more partitions than cores.
ROWS = 500_000
#: Partitions up to which tasks' sums go to the driver without a shuffle, and the length of a shuffled part.
#: With more than one, what the driver gets would grow with the partitions.
DIRECT, PART = 1, 1 << 16
TRAIN, VAL = 1, 2
STATE = "row long, label double, roles binary, margins binary, codes binary"


@dataclass(frozen=True)
class BoostParams:
    leaves: int = 63
    max_depth: int = 6
    step_size: float = 0.05
    max_iter: int = 1000
    feature_fraction: float = 0.8
    bagging_fraction: float = 0.8
    bagging_freq: int = 5
    min_rows: int = 50
    min_hessian: float = 1e-3
    l1: float = 0.1
    l2: float = 0.1
    cat_smooth: float = 10.0
    cat_l2: float = 10.0
    seed: int = 42
    # rounds without a better validation loss after which a model stops
    patience: int = 50
    # bins of a numeric feature's values
    max_bins: int = 64


# ---- bins ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Bins:
    """Bin borders of numeric features and codes of categories; the last bin of each is "missing"."""

    numeric: dict[str, list[float]]
    categories: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categories]

    @property
    def sizes(self) -> np.ndarray:
        """Bins of every feature, with the missing one."""
        return np.array([len(e) + 2 for e in self.numeric.values()] + [len(c) + 1 for c in self.categories.values()])

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """(rows, features) bin numbers.  A category that the fit did not see counts as 'Unknown'."""
        out = np.empty((batch.num_rows, len(self.sizes)), np.uint16)
        for i, (name, edges) in enumerate(self.numeric.items()):
            x = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
            out[:, i] = np.where(np.isfinite(x), np.searchsorted(edges, x, "left"), len(edges) + 1)
        for i, (name, known) in enumerate(self.categories.items(), len(self.numeric)):
            at = pc.index_in(batch.column(name).fill_null("Unknown"), value_set=pa.array(known, pa.string()))
            out[:, i] = at.fill_null(known.index("Unknown") if "Unknown" in known else len(known)).to_numpy(zero_copy_only=False)
        return out


def fit_bins(rows: DataFrame, numeric: list[str], categorical: list[str], common: str, max_bins: int = 64) -> Bins:
    """Borders at quantiles of the rows for which ``common`` holds (those that every model trains on),
    and the categories of all rows in alphabetical order."""
    cuts = [i / max_bins for i in range(1, max_bins)]
    finite = lambda c: F.when(F.expr(common) & (F.abs(F.col(c)) < float("inf")), F.col(c))
    got = rows.agg(*[F.percentile_approx(finite(c), cuts, 100 * max_bins).alias(c) for c in numeric]).first()
    edges = {c: sorted(set(got[c] or [])) for c in numeric}
    seen = {c: sorted(r[0] for r in rows.select(F.coalesce(c, F.lit("Unknown"))).distinct().collect()) for c in categorical}
    return Bins(edges, seen)


# ---- trees --------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in arrays; a leaf is its own child.  ``goes_left[node, bin]``."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    goes_left: np.ndarray
    depth: int

    def leaf(self, codes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(self.depth):
            node = np.where(self.goes_left[node, codes[rows, self.feature[node]]], self.left[node], self.right[node])
        return node


@dataclass
class Model:
    """Start margin, trees and the validation loss after each round; ``best`` trees count."""

    base: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    @property
    def best(self) -> int:
        return int(np.argmin(self.losses)) + 1 if self.losses else len(self.trees)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.base)
        for t in self.trees[: self.best]:
            out += t.value[t.leaf(codes)]
        return out

    def split_counts(self, features: int) -> np.ndarray:
        """How many splits use each feature."""
        out = np.zeros(features, np.int64)
        for t in self.trees[: self.best]:
            np.add.at(out, t.feature[t.left != np.arange(len(t.left))], 1)
        return out


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def _score(g, h, l1: float, l2: float):
    return _shrunk(g, l1) ** 2 / (h + l2)


class _Node:
    """A node under growth: its sums per bin, and its best split."""

    def __init__(self, number: int, depth: int, sums: np.ndarray):
        self.number, self.depth, self.sums = number, depth, sums       # sums: (3, total bins), whole numbers
        self.split: tuple | None = None
        self.children: tuple[_Node, _Node] | None = None


class Splitter:
    """Best splits of nodes over the chosen features of one round."""

    def __init__(self, sizes: np.ndarray, numeric: int, chosen: np.ndarray, p: BoostParams):
        self.p, self.chosen, self.sizes = p, chosen, sizes[chosen]
        self.first = np.cumsum(self.sizes) - self.sizes
        self.total = int(self.sizes.sum())
        plain = np.flatnonzero(chosen < numeric)
        self.plain, self.categorical = plain, np.flatnonzero(chosen >= numeric)
        width = int(self.sizes[plain].max()) - 1 if len(plain) else 0
        at = self.first[plain, None] + np.arange(width)
        self.inside = np.arange(width) < (self.sizes[plain] - 1)[:, None]
        self.at = np.where(self.inside, at, 0)
        self.missing = self.first[plain] + self.sizes[plain] - 1

    def totals(self, sums: np.ndarray) -> np.ndarray:
        """(gradient, hessian, rows) of a node: the sums of any one feature."""
        return sums[:, : self.sizes[0]].sum(axis=1)

    def best(self, node: _Node) -> None:
        """(gain, feature, left bins, left totals) of the node's best split, if any gains."""
        p, whole = self.p, self.totals(node.sums)
        g, h, n = whole[0] / SCALE, whole[1] / SCALE, whole[2]
        if n < 2 * p.min_rows:
            return
        found = (0.0, None, None, None)
        if len(self.plain):
            part = np.where(self.inside, node.sums[:, self.at], 0).cumsum(axis=2)              # (3, features, bins)
            both = np.stack([part, part + node.sums[:, self.missing][:, :, None]], axis=3)    # missing right, left
            gain = self._gains(both, whole, p.l2) - _score(g, h, p.l1, p.l2)
            gain[~self.inside] = -np.inf
            i, t, side = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if gain[i, t, side] > found[0]:
                bins = np.arange(self.sizes[self.plain[i]]) <= t
                bins[-1] = bool(side)
                found = (float(gain[i, t, side]), int(self.plain[i]), bins, both[:, i, t, side])
        for i in self.categorical:
            sums = node.sums[:, self.first[i]: self.first[i] + self.sizes[i] - 1]
            held = np.flatnonzero(sums[2])
            order = held[np.argsort((sums[0, held] / SCALE) / (sums[1, held] / SCALE + p.cat_smooth), kind="stable")]
            left = sums[:, order].cumsum(axis=1)
            gain = self._gains(left, whole, p.l2 + p.cat_l2) - _score(g, h, p.l1, p.l2)
            t = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[t] > found[0]:
                bins = np.zeros(self.sizes[i], bool)
                bins[order[: t + 1]] = True
                found = (float(gain[t]), int(i), bins, left[:, t])
        node.split = found if found[1] is not None else None

    def _gains(self, left: np.ndarray, whole: np.ndarray, l2: float) -> np.ndarray:
        p, right = self.p, whole.reshape((3,) + (1,) * (left.ndim - 1)) - left
        enough = (np.minimum(left[2], right[2]) >= p.min_rows) & (np.minimum(left[1], right[1]) / SCALE >= p.min_hessian)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = _score(left[0] / SCALE, left[1] / SCALE, p.l1, l2) + _score(right[0] / SCALE, right[1] / SCALE, p.l1, l2)
        return np.where(enough, gain, -np.inf)

    def tree(self, root: _Node, nodes: list[_Node], leaf_totals: dict[int, np.ndarray], width: int) -> Tree:
        """The splits by falling gain until the tree has its number of leaves."""
        p, kept, heap = self.p, {}, []
        if root.split:
            heap.append((-root.split[0], root.number, root))
        while heap and len(kept) + 1 < p.leaves:
            _, _, node = heapq.heappop(heap)
            kept[node.number] = node
            for child in node.children or ():
                if child.split and child.children:
                    heapq.heappush(heap, (-child.split[0], child.number, child))
        order, at, depth = [root], 0, 0
        while at < len(order):
            if order[at].number in kept:
                order += order[at].children
            at += 1
        name = {x.number: i for i, x in enumerate(order)}
        size = len(order)
        tree = Tree(np.zeros(size, np.int32), np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32), np.zeros(size),
                    np.zeros((size, width), bool), 0)
        for i, x in enumerate(order):
            if x.number in kept:
                _, f, bins, _ = x.split
                tree.feature[i] = self.chosen[f]
                tree.goes_left[i, : len(bins)] = bins
                tree.left[i], tree.right[i] = (name[c.number] for c in x.children)
                depth = max(depth, x.depth + 1)
            else:
                g, h = leaf_totals[x.number][:2] / SCALE
                tree.value[i] = -float(_shrunk(np.array(g), p.l1)) / (h + p.l2) * p.step_size
        tree.depth = depth
        return tree


# ---- passes over the table ----------------------------------------------------------------

def _binary_rows(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A column of equally long binaries as a matrix."""
    if not len(column):
        return np.zeros((0, width), dtype)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32 if pa.types.is_binary(column.type) else np.int64)[column.offset]
    return np.frombuffer(data, dtype, len(column) * width, int(first)).reshape(len(column), width)


def _as_binary(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    step = matrix.dtype.itemsize * matrix.shape[1]
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * step
    return pa.Array.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix)]).cast(pa.binary())


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_bag(row: np.ndarray, seed: int, epoch: int, fraction: float) -> np.ndarray:
    """The rows of a bag, by a hash of their key; the same in every model and partitioning."""
    salt = _mixed(np.array([seed * 1_000_003 + epoch], np.uint64))
    return _mixed(row.view(np.uint64) ^ salt) < np.uint64(min(int(fraction * 2.0 ** 64), 2 ** 64 - 1))


@dataclass
class Ask:
    """What one pass sums for one model: trees to add to the margins, the tree under growth, and which
    of its leaves get a place in the sums."""

    model: int
    pending: list[Tree]
    partial: Tree | None
    place: dict[int, int]


def _gradients(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = probability(margin)
    return np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE)


class Table:
    """The stored binned rows of one run, with the margins up to the last rewrite."""

    def __init__(self, rows: DataFrame, models: int, features: int):
        self.models, self.features = models, features
        self.rows, self.parts = None, 0
        self.start = np.zeros(models)                           # margins that the stored ones lack
        self._store(rows)

    def _store(self, rows: DataFrame) -> None:
        old, self.rows = self.rows, written(rows, "boosting")
        self.parts = len(self.rows.inputFiles())
        if old is not None:
            forget(old)

    def columns(self, batch: pa.RecordBatch):
        return (batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).to_numpy(zero_copy_only=False),
                _binary_rows(batch.column(2), np.uint8, self.models), _binary_rows(batch.column(3), np.float64, self.models),
                _binary_rows(batch.column(4), np.uint16, self.features))

    def __getstate__(self):
        return {"models": self.models, "features": self.features, "start": self.start}

    def summed(self, task, size: int) -> np.ndarray:
        """The sum over all partitions of the int64 arrays of ``size`` that ``task(batches)`` makes."""
        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([task(batches).tobytes()], pa.binary())], ["part", "sums"])

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x = task(batches)
            cut = [x[i: i + PART].tobytes() for i in range(0, len(x), PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], ["part", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, sums in zip(*(c.to_pylist() for c in batch.columns)):
                    x = np.frombuffer(sums, np.int64)
                    held[part] = held[part] + x if part in held else x
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                             ["part", "sums"])

        out = np.zeros(size, np.int64)
        if self.parts <= DIRECT:
            for r in self.rows.mapInArrow(whole, "part int, sums binary").collect():
                out += np.frombuffer(r["sums"], np.int64)
        else:
            reducers = min(self.parts, -(-size // PART))
            reduced = self.rows.mapInArrow(parts, "part int, sums binary").repartition(reducers, "part").mapInArrow(add, "part int, sums binary")
            for r in reduced.collect():
                out[r["part"] * PART: r["part"] * PART + len(r["sums"]) // 8] += np.frombuffer(r["sums"], np.int64)
        return out

    def bases(self) -> list[float]:
        """Log odds of each model's training labels, from which its margins start."""
        def count(batches):
            out = np.zeros((self.models, 2), np.int64)
            for batch in batches:
                _, y, roles, _, _ = self.columns(batch)
                out += np.stack([(roles == TRAIN).sum(axis=0), ((roles == TRAIN) & (y[:, None] > 0.5)).sum(axis=0)], axis=1)
            return out.ravel()

        n, ones = self.summed(count, 2 * self.models).reshape(-1, 2).T
        share = np.clip(ones / np.maximum(n, 1), 1e-12, 1 - 1e-12)
        self.start = np.log(share / (1 - share))
        return self.start.tolist()

    def histograms(self, asks: list[Ask], chosen: np.ndarray, first: np.ndarray, total: int, bag: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Sums (place, 3, bins) of all asked leaves, and (loss, rows) of every model's validation rows."""
        places = sum(len(a.place) for a in asks)

        def count(batches):
            sums, loss = np.zeros((places, 3, total), np.int64), np.zeros((self.models, 2), np.int64)
            for batch in batches:
                row, y, roles, stored, codes = self.columns(batch)
                bagged = in_bag(row, *bag)
                for a in asks:
                    use = np.flatnonzero(roles[:, a.model] > 0)
                    if not len(use):
                        continue
                    part = codes[use]
                    margin = self.start[a.model] + stored[use, a.model]
                    for t in a.pending:
                        margin += t.value[t.leaf(part)]
                    role = roles[use, a.model]
                    if a.partial is None:
                        v = role == VAL
                        loss[a.model] += (int(np.rint(np.logaddexp(0, np.where(y[use][v] > 0.5, -margin[v], margin[v])) * SCALE).sum()), int(v.sum()))
                    fit = (role == TRAIN) & bagged[use]
                    if not a.place or not fit.any():
                        continue
                    leaf = a.partial.leaf(part[fit]) if a.partial is not None else np.zeros(int(fit.sum()), np.int64)
                    spot = np.full(int(leaf.max()) + 1, -1)
                    for k, v in a.place.items():
                        if k < len(spot):
                            spot[k] = v
                    at = spot[leaf]
                    here = np.flatnonzero(at >= 0)
                    rows = np.flatnonzero(fit)[here]
                    g, h = _gradients(y[use][rows], margin[rows])
                    low, many = min(a.place.values()), len(a.place)
                    spots = ((at[here] - low)[:, None] * total + first + part[rows][:, chosen]).ravel()
                    out = sums[low: low + many]
                    out[:, 2] += np.bincount(spots, minlength=many * total).reshape(many, total)
                    for k, x in enumerate((g, h)):
                        out[:, k] += np.bincount(spots, np.repeat(x, len(chosen)), many * total).reshape(many, total).astype(np.int64)
            return np.concatenate([sums.ravel(), loss.ravel()])

        got = self.summed(count, places * 3 * total + 2 * self.models)
        return got[: places * 3 * total].reshape(places, 3, total), got[places * 3 * total:].reshape(-1, 2)

    def settle(self, pending: dict[int, list[Tree]]) -> None:
        """Write the table anew with the pending trees in its margins."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, _, _, stored, codes = self.columns(batch)
                margins = self.start + stored
                for m, trees in pending.items():
                    for t in trees:
                        margins[:, m] += t.value[t.leaf(codes)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], _as_binary(margins), batch.column(4)],
                                                 ["row", "label", "roles", "margins", "codes"])

        self._store(self.rows.mapInArrow(add, STATE))
        self.start = np.zeros(self.models)

    def scores(self, models: list[Model]) -> DataFrame:
        """model, label and prob_up of every model's validation rows, by its best trees."""
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, y, roles, _, codes = self.columns(batch)
                for i, m in enumerate(models):
                    v = roles[:, i] == VAL
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(v.sum()), i, np.int32)), pa.array(y[v]),
                                                      pa.array(probability(m.margins(codes[v])))], ["model", "label", "prob_up"])

        return self.rows.mapInArrow(score, "model int, label double, prob_up double")


def binned(rows: DataFrame, bins: Bins, roles: str, models: int, row: str, label: str) -> Table:
    """The stored table of ``rows``: ``roles`` is an array of one role a model (0: none), ``row`` a long key."""
    names = bins.names

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            role = np.array(batch.column(2).to_pylist(), np.uint8).reshape(batch.num_rows, models)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _as_binary(role), _as_binary(np.zeros((batch.num_rows, models))),
                                              _as_binary(bins.codes(batch))], ["row", "label", "roles", "margins", "codes"])

    count = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-count // ROWS), min(cores, count // 8192))
    source = rows.select(F.expr(row).cast("long").alias("row"), F.col(label).cast("double").alias("label"), F.col(roles).alias("roles"), *names)
    return Table(source.repartition(parts, "row").mapInArrow(encode, STATE), models, len(names))


# ---- training -----------------------------------------------------------------------------

def fit_boosted(table: Table, bins: Bins, p: BoostParams = BoostParams()) -> list[Model]:
    """One model per role of the table, all trained together; each stops by its own rule."""
    sizes, width, numeric = bins.sizes, int(bins.sizes.max()), len(bins.numeric)
    models = [Model(b) for b in table.bases()]
    pending: dict[int, list[Tree]] = {m: [] for m in range(len(models))}
    active = list(range(len(models)))
    for rounds in range(p.max_iter + 1):
        chosen = np.sort(np.random.default_rng([p.seed, rounds]).choice(len(sizes), max(1, round(p.feature_fraction * len(sizes))), replace=False))
        cut = Splitter(sizes, numeric, chosen, p)
        bag = (p.seed, rounds // p.bagging_freq, p.bagging_fraction)

        def passed(wanted: dict[int, dict[int, int]], partial: dict[int, Tree] | None):
            asks = [Ask(m, pending[m], partial[m] if partial else None, wanted[m]) for m in active if partial is None or wanted[m]]
            return table.histograms(asks, chosen, cut.first, cut.total, bag)

        grows = rounds < p.max_iter
        sums, loss = passed({m: {0: i} if grows else {} for i, m in enumerate(active)}, None)
        place = {m: i for i, m in enumerate(active)}
        if rounds:
            for m in active:
                models[m].losses.append(loss[m, 0] / SCALE / max(loss[m, 1], 1))
            active = [m for m in active if len(models[m].losses) - models[m].best < p.patience]
        if not active or not grows:
            break
        grown = {m: _Growth(_Node(0, 0, sums[place[m]]), cut, width) for m in active}
        for depth in range(p.max_depth - 1):
            wanted, at = {}, 0
            for m in active:
                wanted[m] = {}
                for number in grown[m].split_level(depth):
                    wanted[m][number] = at
                    at += 1
            if not at:
                break
            sums, _ = passed({m: {grown[m].partial_place[k]: v for k, v in w.items()} for m, w in wanted.items()}, {m: grown[m].partial for m in active})
            for m in active:
                grown[m].fill({k: sums[v] for k, v in wanted[m].items()})
        for m in active:
            grown[m].split_level(p.max_depth - 1)
            tree = grown[m].finish()
            models[m].trees.append(tree)
            pending[m].append(tree)
        if (rounds + 1) % KEEP == 0:
            table.settle({m: t for m, t in pending.items() if t})
            pending = {m: [] for m in pending}
    return models


class _Growth:
    """One tree under growth, level by level."""

    def __init__(self, root: _Node, cut: Splitter, width: int):
        self.root, self.cut, self.width = root, cut, width
        self.nodes, self.level = [root], [root]
        self.totals = {0: cut.totals(root.sums)}
        self.partial: Tree | None = None
        self.partial_place: dict[int, int] = {}
        self.twins: dict[int, tuple[_Node, _Node]] = {}

    def split_level(self, depth: int) -> list[int]:
        """Split the level's nodes; returns the numbers of the children to be summed (the smaller of two)."""
        below, ask = [], []
        self.twins = {}
        for node in self.level:
            if node.sums is None or node.depth != depth:
                continue
            self.cut.best(node)
            if not node.split:
                continue
            left = node.split[3]
            right = self.totals[node.number] - left
            a, b = _Node(len(self.nodes), depth + 1, None), _Node(len(self.nodes) + 1, depth + 1, None)
            self.nodes += [a, b]
            node.children = (a, b)
            self.totals[a.number], self.totals[b.number] = left, right
            small = a if left[2] <= right[2] else b
            self.twins[small.number] = (node, b if small is a else a)
            ask.append(small.number)
            below += [a, b]
        self.level = below
        if ask:
            self.partial = self._as_tree(depth + 1)
        return ask

    def _as_tree(self, depth: int) -> Tree:
        size = len(self.nodes)
        tree = Tree(np.zeros(size, np.int32), np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32), np.zeros(size),
                    np.zeros((size, self.width), bool), depth)
        for x in self.nodes:
            if x.children:
                tree.feature[x.number] = self.cut.chosen[x.split[1]]
                tree.goes_left[x.number, : len(x.split[2])] = x.split[2]
                tree.left[x.number], tree.right[x.number] = (c.number for c in x.children)
        self.partial_place = {x.number: x.number for x in self.nodes}
        return tree

    def fill(self, sums: dict[int, np.ndarray]) -> None:
        for number, got in sums.items():
            node, sister = self.twins[number]
            self.nodes[number].sums = got
            sister.sums = node.sums - got
            node.sums = None

    def finish(self) -> Tree:
        return self.cut.tree(self.root, self.nodes, self.totals, self.width)


def predicted(rows: DataFrame, bins: Bins, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and prob_up of every row."""
    fields = rows.select(keep).schema.fields
    names = bins.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = probability(model.margins(bins.codes(batch)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(got)], [*keep, "prob_up"])

    return rows.select(*keep, *[c for c in names if c not in keep]).mapInArrow(score, StructType([*fields, StructField("prob_up", DoubleType())]))
