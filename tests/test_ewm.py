import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barwise.operators.ewm import EwmSpec, ewm
from barwise.operators.windows import add_bar_index


def _frame(spark, series: dict):
    rows = []
    for sym, vals in series.items():
        for i, v in enumerate(vals):
            rows.append((sym, pd.Timestamp("2000-01-01").date() + pd.Timedelta(days=i), None if np.isnan(v) else float(v)))
    return add_bar_index(spark.createDataFrame(rows, "symbol string, date date, x double"))


@pytest.mark.parametrize("alpha", [0.2, 1 / 14, 2 / 13, 2 / 27])
def test_ewm_matches_pandas_with_gaps(spark, alpha):
    rng = np.random.default_rng(7)
    a = rng.normal(50, 3, 700)
    b = rng.normal(10, 1, 600)
    b[:5] = np.nan                  # leading nulls
    b[rng.random(600) < 0.15] = np.nan
    b[300:420] = np.nan             # long interior gap across a block end
    c = np.full(40, 5.0)            # constant
    out = ewm(_frame(spark, {"A": a, "B": b, "C": c}), [EwmSpec("y", "x", alpha)]).toPandas()
    for sym, vals in {"A": a, "B": b, "C": c}.items():
        got = out[out.symbol == sym].sort_values("rn")["y"].to_numpy(dtype=float)
        ref = pd.Series(vals).ewm(alpha=alpha, adjust=False).mean().to_numpy()
        assert np.array_equal(np.isnan(got), np.isnan(ref))
        m = ~np.isnan(ref)
        np.testing.assert_allclose(got[m], ref[m], rtol=1e-11)


def test_ewm_all_null_series_stays_null(spark):
    out = ewm(_frame(spark, {"N": np.full(10, np.nan)}), [EwmSpec("y", "x", 0.2)])
    assert out.where(F.col("y").isNotNull()).count() == 0


@pytest.mark.parametrize("alpha", [0.2, 2 / 27])
def test_dense_path_matches_pandas(spark, alpha):
    rng = np.random.default_rng(11)
    a = rng.normal(100, 4, 900)
    a[:3] = np.nan                       # NULLs only before the first value
    df = _frame(spark, {"D": a})
    df = df.withColumn("first", F.min(F.when(F.col("x").isNotNull(), F.col("rn"))).over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("symbol")))
    out = ewm(df, [EwmSpec("y", "x", alpha, "first"), EwmSpec("g", "x", alpha)]).toPandas().sort_values("rn")
    ref = pd.Series(a).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    for col in ("y", "g"):
        got = out[col].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(got), np.isnan(ref))
        m = ~np.isnan(ref)
        np.testing.assert_allclose(got[m], ref[m], rtol=1e-11)
