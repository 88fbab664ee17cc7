"""Distributed histogram boosting against a plain numpy twin that grows one leaf at a time."""

import heapq

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barwise import catalog
from barwise.operators import boosting as B
from barwise.plans import model as MD
from barwise.session import written

SF_SMALL = "/root/testdata/sf0.001"
NUMERIC, CATEGORIES = ["a", "b", "c", "d"], ["k"]


def rows(n, seed=3):
    rnd = np.random.default_rng(seed)
    a, b, c = rnd.normal(size=n), rnd.integers(0, 9, n).astype(float), rnd.exponential(size=n)
    k = rnd.integers(0, 12, n)
    y = (a + 0.3 * b * (c > 0.7) + np.where(k % 3 == 0, 1.5, -0.5) + rnd.normal(size=n) > 0.8).astype(float)
    a[rnd.random(n) < 0.1] = np.nan
    c[rnd.random(n) < 0.05] = np.inf
    d = np.where(rnd.random(n) < 0.5, np.nan, 1.0)
    roles = np.stack([np.where(np.arange(n) < 0.7 * n, 1, np.where(np.arange(n) < 0.8 * n, 2, 0)), np.where(np.arange(n) < 0.8 * n, 1, 2)], axis=1)
    return [(i, float(y[i]), roles[i].tolist(), *(None if np.isnan(x[i]) else float(x[i]) for x in (a, b, c, d)), None if k[i] == 11 else f"k{k[i]}") for i in range(n)]


SCHEMA = "row long, y double, roles array<int>, a double, b double, c double, d double, k string"


def codes_of(bins, data):
    batch = pa.RecordBatch.from_pydict({n: [r[3 + i] for r in data] for i, n in enumerate(NUMERIC + CATEGORIES)})
    return bins.codes(batch).astype(int)


def twin(codes, y, role, row, bins, p, rounds):
    """Margins and splits of one model, grown leaf by leaf, every split by trying every place."""
    sizes, train = bins.sizes, role == 1
    share = y[train].mean()
    margin, splits = np.full(len(y), np.log(share / (1 - share))), []
    shrink = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    score = lambda g, h, l2: shrink(g) ** 2 / (h + l2)
    for r in range(rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = np.rint((prob - y) * B.SCALE), np.rint(prob * (1 - prob) * B.SCALE)
        chosen = np.sort(np.random.default_rng([p.seed, r]).choice(len(sizes), max(1, round(p.feature_fraction * len(sizes))), replace=False))
        used = train & B.in_bag(row, p.seed, r // p.bagging_freq, p.bagging_fraction)

        def total(mask):
            return g[mask].sum() / B.SCALE, h[mask].sum() / B.SCALE, int(mask.sum())

        def best(inside):
            mine, found = inside & used, None
            G, H, n = total(mine)

            def attempt(f, left_bins, l2):
                nonlocal found
                left = mine & left_bins[codes[:, f]]
                gl, hl, nl = total(left)
                gr, hr, nr = total(mine & ~left)
                if min(nl, nr) < p.min_rows or min(hl, hr) < p.min_hessian:
                    return
                gain = score(gl, hl, l2) + score(gr, hr, l2) - score(G, H, p.l2)
                if gain > (found[0] if found else 0):
                    found = (gain, f, left_bins)
            for f in chosen:
                size = sizes[f]
                if f < len(NUMERIC):
                    for t in range(size - 1):
                        for missing in (False, True):
                            attempt(f, np.r_[np.arange(size - 1) <= t, missing], p.l2)
                else:
                    held = [x for x in range(size - 1) if (mine & (codes[:, f] == x)).any()]
                    ratio = [total(mine & (codes[:, f] == x)) for x in held]
                    order = [x for _, x in sorted((a / (b + p.cat_smooth), x) for (a, b, _), x in zip(ratio, held))]
                    for t in range(len(order)):
                        attempt(f, np.isin(np.arange(size), order[: t + 1]), p.l2 + p.cat_l2)
            return found

        leaves, heap, number = {0: (np.ones(len(y), bool), 0)}, [], 0

        def offer(name):
            inside, depth = leaves[name]
            s = best(inside) if depth < p.max_depth else None
            if s:
                heapq.heappush(heap, (-s[0], name, s))
        offer(0)
        while heap and len(leaves) < p.leaves:
            _, name, (_, f, left_bins) = heapq.heappop(heap)
            inside, depth = leaves.pop(name)
            splits.append(f)
            left = left_bins[codes[:, f]]
            for part in (inside & left, inside & ~left):
                number += 1
                leaves[number] = (part, depth + 1)
                offer(number)
        for inside, _ in leaves.values():
            G, H, _ = total(inside & used)
            margin[inside] += -shrink(G) / (H + p.l2) * p.step_size
    return margin, splits


@pytest.mark.parametrize("leaves", [63, 7])
def test_trees_equal_the_numpy_twin(spark, monkeypatch, leaves):
    data = rows(5000)
    p = B.BoostParams(max_iter=3, max_bins=16, leaves=leaves, max_depth=5, patience=9)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    bins = B.fit_bins(df, NUMERIC, CATEGORIES, "roles[0] = 1", p.max_bins)
    assert bins.categories["k"][0] == "Unknown" and len(bins.numeric["d"]) == 1
    monkeypatch.setattr(B, "KEEP", 2)
    table = B.binned(df, bins, "roles", 2, "row", "y")
    models = B.fit_boosted(table, bins, p)
    codes, y, row = codes_of(bins, data), np.array([r[1] for r in data]), np.array([r[0] for r in data], np.int64)
    for m, model in enumerate(models):
        role = np.array([r[2][m] for r in data])
        want, splits = twin(codes, y, role, row, bins, p, p.max_iter)
        whole = B.Model(model.base, model.trees)
        assert np.abs(whole.margins(codes) - want).max() < 1e-12
        assert whole.split_counts(len(bins.names)).tolist() == np.bincount(splits, minlength=5).tolist()
        v = role == 2
        loss = np.logaddexp(0, np.where(y[v] > 0.5, -want[v], want[v])).mean()
        assert abs(model.losses[-1] - loss) < 1e-6


def test_sums_do_not_depend_on_partitions_or_company(spark, monkeypatch):
    df = written(spark.createDataFrame(rows(4000, 5), SCHEMA), "rows")
    p = B.BoostParams(max_iter=60, patience=4, max_bins=16, max_depth=4, step_size=0.7)
    bins = B.fit_bins(df, NUMERIC, CATEGORIES, "roles[0] = 1", p.max_bins)
    passes = []
    inner = B.Table.histograms
    monkeypatch.setattr(B.Table, "histograms", lambda self, *a: passes.append(1) or inner(self, *a))

    def fit(roles, n, keep, rows_each):
        monkeypatch.setattr(B, "KEEP", keep)
        monkeypatch.setattr(B, "ROWS", rows_each)
        passes.clear()
        return B.fit_boosted(B.binned(df.withColumn("roles", roles), bins, "roles", n, "row", "y"), bins, p), len(passes)
    both, n_both = fit(F.col("roles"), 2, 3, 10_000)
    monkeypatch.setattr(B, "DIRECT", 1)                         # sums through the shuffle
    alone = [fit(F.slice("roles", i, 1), 1, 100, 700) for i in (1, 2)]
    for m, (single, _) in zip(both, alone):
        assert m.losses == single[0].losses and len(m.trees) == len(single[0].trees) == m.best + p.patience
        for t, u in zip(m.trees, single[0].trees):
            assert (t.feature == u.feature).all() and (t.value == u.value).all() and (t.goes_left == u.goes_left).all()
    assert n_both == max(n for _, n in alone)                   # one scan a pass for all models together


def test_rare_missing_values_are_split_off(spark):
    n = 30_000
    rnd = np.random.default_rng(1)
    x, gone = rnd.normal(size=n), np.arange(n) % 500 == 0       # 0.2 % missing, and they decide the label
    data = [(i, float(gone[i] or rnd.random() < 0.1), [1], None if gone[i] else float(x[i]), float(rnd.normal())) for i in range(n)]
    df = spark.createDataFrame(data, "row long, y double, roles array<int>, a double, b double")
    bins = B.fit_bins(df, ["a", "b"], [], "true")
    p = B.BoostParams(max_iter=1, feature_fraction=1.0, bagging_fraction=1.0, step_size=1.0)
    tree = B.fit_boosted(B.binned(df, bins, "roles", 1, "row", "y"), bins, p)[0].trees[0]
    missing = len(bins.numeric["a"]) + 1
    at = tree.leaf(np.array([[missing, 3], [5, 3]]))
    assert tree.feature[0] == 0 and tree.goes_left[0].sum() in (missing, 1) and tree.value[at[0]] > 1 > tree.value[at[1]]


def test_folds_and_final_fit_share_their_passes(spark):
    feats = written(catalog.rounded_features(spark, SF_SMALL), "features")
    p = MD.BoostParams(max_iter=2, patience=2)
    run, folds, final = MD.fit_together(feats, p), MD.fit_together(feats, p, final=False), MD.fit_together(feats, p, folds=False)
    assert [m.losses for m in run.models] == [m.losses for m in folds.models + final.models]
    apart = sorted(map(tuple, folds.scores().collect()))
    assert sorted(tuple(r) for r in run.scores().collect() if r.model < 3) == apart
