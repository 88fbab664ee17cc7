"""The day's feature update against the full build, for every column."""

import datetime as dt
import random

from pyspark.sql import functions as F

from barwise.operators import snapshots as S
from barwise.plans.features import FEATURE_COLS, build_features, to_feature_schema
from barwise.plans.incremental import changed_from, update_features

BARS = "symbol string, date date, open double, high double, low double, close double, volume long"
START = dt.date(2015, 1, 1)


def series(symbol, n, seed, gaps=0.0, skip=()):
    rnd, price, out = random.Random(seed), 100.0, []
    for i in range(n):
        price = round(max(5.0, price * (1 + rnd.gauss(0, 0.02))), 2)
        high, low = round(price * 1.01, 2), round(price * 0.99, 2)
        if rnd.random() < gaps:
            high = low = None
        if i not in skip:
            out.append((symbol, START + dt.timedelta(days=i), price, high, low, price, rnd.randrange(1000, 9000)))
    return out


def full(bars, events, universe):
    return to_feature_schema(build_features(bars, *events, universe), "2030-01-01 00:00:00").where("_status = 'success'").select(FEATURE_COLS)


def test_a_day_equals_the_full_build(spark, tmp_path):
    day = START + dt.timedelta(days=999)
    old = (series("A", 999, 1) + series("B", 999, 2, skip={700}) + series("C", 999, 3, gaps=0.6) + series("D", 70, 4) + series("E", 999, 5)
           + series("quiet", 900, 6) + series("short", 58, 7))
    late = [r for r in series("B", 999, 2) if r[1] == START + dt.timedelta(days=700)]
    fixed = [(*r[:5], round(r[5] * 1.1, 2), r[6]) for r in old if r[0] == "A" and r[1] == START + dt.timedelta(days=980)]
    new = [(s, day, 90.0, 91.0, 89.0, 90.5, 5) for s in ("A", "B", "C", "D", "E", "short")] + [("short", day + dt.timedelta(days=1), 90.0, 91.0, 89.0, 90.0, 5)]
    new += series("fresh", 300, 8)
    batch = spark.createDataFrame(new + late + fixed, BARS)
    keys = {(r[0], r[1]) for r in new + late + fixed}
    before, after = spark.createDataFrame(old, BARS), spark.createDataFrame([r for r in old if (r[0], r[1]) not in keys] + new + late + fixed, BARS)
    fund = lambda rows: spark.createDataFrame(rows, "symbol string, as_of_date date, pe_ratio double, pb_ratio double, eps double, revenue long, "  # noqa: E731
                                              "net_income long, debt_to_equity double, roe double, market_cap long")
    quarter = [(s, START + dt.timedelta(days=90 * k), 10.0 + k, 1.0, None, k, k, 0.5, 0.1, 7) for s in "ABCE" for k in range(10)]
    paid = lambda rows: spark.createDataFrame(rows, "symbol string, ex_date date, amount double")
    dividends = [("A", START + dt.timedelta(days=950), 1.0), ("B", START + dt.timedelta(days=20), 2.0)]
    first = [("E", day, 3.0)]                                   # E's first dividend: its yield is no longer NULL in any row
    splits = spark.createDataFrame([("C", START + dt.timedelta(days=400), 2.0)], "symbol string, split_date date, ratio double")
    named = lambda x: spark.createDataFrame([(s, x if s == "D" else "Tech", "i") for s in ("A", "B", "C", "D", "E", "quiet", "short", "fresh")],
                                            "yf_symbol string, sector string, industry string")
    table, log = f"{tmp_path}/features", f"{tmp_path}/log"
    start = full(before, (fund(quarter), paid(dividends), splits), named("Old")).withColumn("computed_at", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    S.replace(spark, table, start, ["symbol", "date"], F.date_format("date", "yyyy-MM"))
    changed = changed_from((batch, "date"), (paid(first), "ex_date"))
    got = update_features(spark, after, fund(quarter), paid(dividends + first), splits, named("New"), changed, table, log, "r", "2030-01-01 00:00:00")
    want = full(after, (fund(quarter), paid(dividends + first), splits), named("New"))
    have = got["features"].select(FEATURE_COLS)
    assert have.count() == want.count() and have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty()
    n = {r.symbol: r["count"] for r in got["rows"].collect()}
    # A from the corrected bar, B from the late one, C from the day, each with the five bars before; D, E and fresh in full, as is short, which has its 60 bars now
    assert n == {"A": 20 + 5, "B": 300 + 5, "C": 1 + 5, "D": 71, "E": 1000, "fresh": 300, "short": 60}
    kept = got["features"].where("computed_at < '2025-01-01'").groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in kept} == {"A": 1000 - 25, "B": 1000 - 305, "C": 1000 - 6, "quiet": 900}


def test_a_day_rewrites_its_months(spark, tmp_path):
    bars = spark.createDataFrame(series("A", 900, 1) + series("B", 900, 2), BARS)
    none = [spark.createDataFrame([], s) for s in ("symbol string, as_of_date date, pe_ratio double, pb_ratio double, eps double, revenue long, "
                                                   "net_income long, debt_to_equity double, roe double, market_cap long",
                                                   "symbol string, ex_date date, amount double", "symbol string, split_date date, ratio double")]
    universe = spark.createDataFrame([("A", "s", "i"), ("B", "s", "i")], "yf_symbol string, sector string, industry string")
    table = f"{tmp_path}/features"
    last = START + dt.timedelta(days=899)
    stored = full(bars.where(F.col("date") < last), none, universe).withColumn("computed_at", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    before = S.replace(spark, table, stored, ["symbol", "date"], F.date_format("date", "yyyy-MM"))
    changed = changed_from((bars.where(F.col("date") == last), "date"))
    after = update_features(spark, bars, *none, universe, changed, table, f"{tmp_path}/log", "r", "2030-01-01 00:00:00")["version"]
    months = {(last - dt.timedelta(days=i)).strftime("%Y-%m") for i in range(6)}
    assert {f.part for f in set(before.files) ^ set(after.files)} == months and len(set(before.files) & set(after.files)) >= 28
