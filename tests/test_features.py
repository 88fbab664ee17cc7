"""Feature columns against a row-by-row reading of their definitions, on
hand-made edge series (FIXTURES §3)."""

import datetime as dt
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barwise.plans.features import build_features


def _bars(n, sym, close, high=None, low=None, volume=None):
    d0 = dt.date(2020, 1, 1)
    high = close if high is None else high
    low = close if low is None else low
    volume = np.full(n, 1000.0) if volume is None else volume
    return pd.DataFrame({"symbol": sym, "date": [d0 + dt.timedelta(days=i) for i in range(n)],
                         "open": close, "high": high, "low": low, "close": close,
                         "adj_close": close, "volume": volume.astype("int64")})


class Walk:
    """One symbol's bars, walked row by row; every value follows its
    definition (SURVEY §2.4) literally, None standing for NULL."""

    def __init__(self, bars):
        clean = lambda xs: [None if x != x else float(x) for x in xs]
        self.close, self.high, self.low, self.volume = (clean(bars[c]) for c in ("close", "high", "low", "volume"))
        self.rows = range(len(self.close))

    def back(self, values, i, k=1):
        return values[i - k] if 0 <= i - k < len(values) else None

    def full(self, values, i, n):
        """The last n values up to row i, or None if one is missing."""
        part = values[max(0, i - n + 1): i + 1]
        return part if len(part) == n and None not in part else None

    @staticmethod
    def quotient(a, b):
        return None if a is None or b is None or b == 0 else a / b

    def over(self, values, n, fn):
        return [fn(p) if (p := self.full(values, i, n)) else None for i in self.rows]

    def smooth(self, values, alpha):
        """Exponential mean: seeded by the first value; the weight of the past decays over gaps."""
        out, level, weight = [], None, 1.0
        for x in values:
            if level is not None:
                weight *= 1 - alpha
            if x is not None:
                level = x if level is None else (weight * level + alpha * x) / (weight + alpha)
                weight = 1.0
            out.append(level)
        return out

    def columns(self):
        q, close = self.quotient, self.close
        move = [None if i == 0 else close[i] - close[i - 1] for i in self.rows]
        gain = self.smooth([None if m is None else max(m, 0.0) for m in move], 1 / 14)
        fall = self.smooth([None if m is None else max(-m, 0.0) for m in move], 1 / 14)
        strength = [q(g, f) for g, f in zip(gain, fall)]
        daily = [None if (r := q(close[i], self.back(close, i))) is None else r - 1 for i in self.rows]
        spread, centre = self.over(close, 20, statistics.stdev), self.over(close, 20, statistics.fmean)
        ranges = []
        for i in self.rows:
            ends = [(self.high[i], self.low[i]), (self.high[i], self.back(close, i)), (self.low[i], self.back(close, i))]
            ranges.append(max((abs(x - y) for x, y in ends if x is not None and y is not None), default=None))
        bottom, top = self.over(self.low, 14, min), self.over(self.high, 14, max)
        later = lambda i: close[i + 1] if i + 1 < len(close) else None
        return {
            "daily_return": daily, "sma_5": self.over(close, 5, statistics.fmean), "sma_200": self.over(close, 200, statistics.fmean),
            "ema_12": self.smooth(close, 2 / 13), "rsi_14": [None if s is None else 100 - 100 / (1 + s) for s in strength],
            "bb_pct": [None if s is None else q(c - m + 2 * s, 4 * s) for c, m, s in zip(close, centre, spread)],
            "atr_14": self.smooth(ranges, 1 / 14),
            "stoch_k": [None if a is None or z is None else q(100 * (c - a), z - a) for c, a, z in zip(close, bottom, top)],
            "volume_ratio": [q(v, m) for v, m in zip(self.volume, self.over(self.volume, 20, statistics.fmean))],
            "high_52w": self.over(self.high, 252, max), "rolling_std_5": self.over(daily, 5, statistics.stdev),
            "target_return_1d": [None if later(i) is None else q(later(i) - close[i], close[i]) for i in self.rows]}


COLS = ["daily_return", "sma_5", "sma_200", "ema_12", "rsi_14", "bb_pct", "atr_14", "stoch_k",
        "volume_ratio", "high_52w", "rolling_std_5", "target_return_1d"]


@pytest.fixture(scope="module")
def edge_bars():
    rng = np.random.default_rng(3)
    n = 320
    walk = 100 + np.cumsum(rng.normal(0, 1, n))
    hi, lo = walk + rng.random(n), walk - rng.random(n)
    hi[50], lo[50] = np.nan, np.nan           # NULL high / low inside a series
    walk_z = walk.copy()
    walk_z[100] = 0.0                          # close = 0 on one bar
    vol = np.full(n, 500.0)
    vol[30:60] = 0                             # zero volume for 30 bars
    frames = [
        _bars(n, "RAND", walk, hi, lo),
        _bars(n, "ZERO", walk_z, walk_z + 1, walk_z - 1, vol),
        _bars(80, "FLAT", np.full(80, 10.0)),   # constant: std 0, RSI NULL, stoch NULL
        _bars(59, "SHORT", np.linspace(1, 2, 59)),  # below minimum history
        _bars(60, "EXACT", np.linspace(1, 2, 60)),
    ]
    return pd.concat(frames, ignore_index=True)


def test_features_match_their_definitions(spark, edge_bars):
    sdf = spark.createDataFrame(edge_bars)
    got = build_features(sdf).toPandas()
    assert set(got.symbol) == {"RAND", "ZERO", "FLAT", "EXACT"}          # 59 bars dropped
    for sym, p in edge_bars.groupby("symbol"):
        if sym == "SHORT":
            continue
        ref = Walk(p.reset_index(drop=True)).columns()
        g = got[got.symbol == sym].sort_values("date").reset_index(drop=True)
        for c in COLS:
            a, b = g[c].to_numpy(dtype=float), np.array(ref[c], dtype=float)
            assert np.array_equal(np.isnan(a), np.isnan(b)), (sym, c)
            m = ~np.isnan(b)
            np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-9, err_msg=f"{sym} {c}")


def test_properties(spark, edge_bars):
    f = build_features(spark.createDataFrame(edge_bars))
    assert f.where((F.col("rsi_14") < -1e-9) | (F.col("rsi_14") > 100 + 1e-9)).count() == 0
    assert f.where((F.col("stoch_k") < -1e-9) | (F.col("stoch_k") > 100 + 1e-9)).count() == 0
    assert f.where(F.col("pct_from_52w_high") > 1e-12).count() == 0
    flat = f.where(F.col("symbol") == "FLAT")
    assert flat.where(F.col("rsi_14").isNotNull() | F.col("bb_width").isNotNull()).count() == 0


def test_labels_documented_null_vs_legacy_zero(spark, edge_bars):
    sdf = spark.createDataFrame(edge_bars[edge_bars.symbol == "EXACT"])
    last = build_features(sdf).orderBy(F.col("date").desc()).first()
    assert last.target_direction_1d is None
    legacy = build_features(sdf, legacy_labels=True).orderBy(F.col("date").desc()).first()
    assert legacy.target_direction_1d == 0


def test_not_a_number_is_missing(spark, edge_bars):
    """A NaN close drops its bar; it does not stay in the running sums."""
    bars = edge_bars[edge_bars.symbol == "RAND"].reset_index(drop=True)
    broken = bars.copy()
    broken.loc[70, "close"] = np.nan
    broken.loc[71, "open"] = np.inf
    sdf = spark.createDataFrame(broken)
    got = build_features(sdf).toPandas().sort_values("date").reset_index(drop=True)
    ref = build_features(spark.createDataFrame(bars.drop(index=[70, 71]))).toPandas().sort_values("date").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, ref)
    assert got.sma_200.notna().sum() == len(bars) - 2 - 199
