import datetime as dt
import os
import tempfile

import pyarrow as pa
from pyspark.sql import functions as F

from barwise import catalog
from barwise.functions import index_key, local_date, truncate_text
from barwise.plans import model as MD
from barwise.plans.ingest import normalize_events, normalize_fundamentals
from barwise.plans.ingest import ingest, normalize_bars, read_feed
from barwise.plans.jobs import write_importance_csv
from barwise.operators.upsert import dedupe_batch
from barwise.schemas import INGESTION_DELTA, MODEL_RUNS, PRICE_HISTORY

SF_SMALL = "/root/testdata/sf0.001"


def test_train_cv_save_load_score(spark):
    feats = catalog.rounded_features(spark, SF_SMALL).persist()
    p = MD.BoostParams(max_iter=6, patience=3)            # small budget: this tests the plumbing, not the learner
    cv = MD.cross_validate(feats, p)
    folds = cv["folds"].collect()
    assert sorted(r.fold for r in folds) == [1, 2, 3]
    assert all(0 <= r.accuracy <= 1 for r in folds)
    out = MD.train_and_predict(feats, p, run_id="t-run", created_at="2025-01-05 00:00:00")
    pred = out["predictions"].collect()
    assert len(pred) == feats.select("symbol").distinct().count()
    assert all(abs(r.prob_up + r.prob_down - 1) < 1e-12 and r.predicted_direction == (r.prob_up >= 0.5)
               for r in pred)
    root = tempfile.mkdtemp(prefix="barwise-model-")
    MD.save_model(spark, out["model"], root, "t-run")
    again = MD.score_latest(feats, MD.load_model(spark, root, "t-run"), "t-run", "run-1", "2025-01-05 00:00:00")
    a = {r.symbol: r.prob_up for r in pred}
    b = {r.symbol: r.prob_up for r in again.collect()}
    assert a == b
    top = out["top"].collect()
    assert len(top) == 10 and top[0].importance >= top[-1].importance and out["importance"].count() == 49
    write_importance_csv(out["importance"], os.path.join(root, "imp"))
    assert spark.read.option("header", True).csv(os.path.join(root, "imp")).count() == 49
    row = out["run"].first()
    assert row.n_train_rows > row.n_val_rows > 0 and row.n_features == 49 and row.model_version == "run_run-1"
    assert 0 <= row.cv_auc_roc <= 1 and row.val_log_loss > 0 and [(f.name, f.dataType) for f in out["run"].schema] == [(f.name, f.dataType) for f in MODEL_RUNS]


def test_event_and_fundamental_feeds(spark):
    raw = spark.createDataFrame([("A", "2024-03-01", "1.5"), ("A", "2024-09-02", "2")],
                                "symbol string, ex_date string, amount string")
    d = normalize_events(raw, "dividend").collect()
    assert d[0].ex_date == dt.date(2024, 3, 1) and d[1].amount == 2.0
    f = spark.createDataFrame([("A", 20.5, 3.0, 10.0, 1000, 50, 0.4, 0.12, 99999)],
                              "symbol string, trailingPE double, priceToBook double, trailingEps double, "
                              "totalRevenue long, netIncomeToCommon long, debtToEquity double, "
                              "returnOnEquity double, marketCap long")
    r = normalize_fundamentals(f, "2025-01-05").first()
    assert r.as_of_date == dt.date(2025, 1, 5) and r.pe_ratio == 20.5 and r.market_cap == 99999


def test_small_scalar_helpers(spark):
    df = spark.createDataFrame([("^NSEI", "INR=X", dt.datetime(2024, 1, 1, 20, 0), "x" * 600)],
                               "a string, b string, ts timestamp, e string")
    r = df.select(index_key("a").alias("a"), index_key("b").alias("b"),
                  local_date("ts", "Asia/Kolkata").alias("d"), F.length(truncate_text("e", 500)).alias("n")).first()
    assert (r.a, r.b, r.d, r.n) == ("NSEI", "INR_X", dt.date(2024, 1, 2), 500)


def test_feeds_with_unreadable_fields(spark):
    bars = spark.createDataFrame([("A", "2024-01-02 00:00:00", "10", "11", "9", "10.5", "n/a", "nan"), ("A", "bad day", "10", "11", "9", "10.5", "1", "5"),
                                  ("A", "2024-01-03 00:00:00", "NaN", "11", "9", "10.5", "1", "5"), ("A", "2024-01-04 00:00:00", "10", None, "9", "10", "1", "1e30")],
                                 "symbol string, Date string, Open string, High string, Low string, Close string, `Adj Close` string, Volume string")
    got = {r.date: r for r in normalize_bars(bars).collect()}
    assert sorted(got) == [dt.date(2024, 1, 2), dt.date(2024, 1, 4)]
    assert got[dt.date(2024, 1, 2)].volume == 0 and got[dt.date(2024, 1, 2)].adj_close is None and got[dt.date(2024, 1, 4)].volume == 0
    f = normalize_fundamentals(spark.createDataFrame([("A", "N/A", "3.5", "2.5e9", "Infinity")],
                               "symbol string, trailingPE string, priceToBook string, totalRevenue string, marketCap string"), "2025-01-05").first()
    assert (f.pe_ratio, f.pb_ratio, f.revenue, f.market_cap, f.roe) == (None, 3.5, 2_500_000_000, None, None)


def test_feeds_from_csv_and_json(spark):
    root = tempfile.mkdtemp(prefix="barwise-feed-")
    spark.createDataFrame([("A", "2024-05-06", "0.5"), ("A", "?", "1")], "symbol string, split_date string, ratio string").write.option("header", True).csv(f"{root}/csv")
    assert [tuple(r) for r in read_feed(spark, f"{root}/csv", "split", "csv").collect()] == [("A", dt.date(2024, 5, 6), 0.5)]
    spark.createDataFrame([("A", 7.5, "N/A")], "symbol string, trailingPE double, marketCap string").write.json(f"{root}/json")
    assert read_feed(spark, f"{root}/json", "fundamental", "json", "2025-01-05").first().pe_ratio == 7.5


def test_duplicate_keys_do_not_depend_on_the_partitioning(spark):
    rows = [("A", dt.date(2024, 1, 2), float(i), 1.0, 1.0, 1.0, 1.0, i) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, adj_close double, volume long")
    assert {dedupe_batch(df.repartition(n), ["symbol", "date"]).first().open for n in (1, 3, 7)} == {39.0}
    assert dedupe_batch(df.repartition(5), ["symbol", "date"], "volume").first().volume == 39
    uni = spark.createDataFrame([("A",)], "yf_symbol string")
    out = ingest(spark.createDataFrame([], PRICE_HISTORY), df, uni, spark.createDataFrame([], INGESTION_DELTA), "price", "2025-01-05", "r", "2025-01-05 00:00:00")
    assert out["ledger"].first().record_count == out["table"].count() == 1


def _signal(spark, n=1500, industries=200):
    import random
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        x = rnd.gauss(0, 1)
        rows.append((f"S{i % 10}", dt.date(2015, 1, 1) + dt.timedelta(days=i // 10), x, f"sector {i % 7}", f"industry {i % industries}", int(x + rnd.gauss(0, 0.5) > 0)))
    df = spark.createDataFrame(rows, "symbol string, date date, rsi_14 double, sector string, industry string, target_direction_1d int")
    return df.select("*", *[F.lit(None).cast("double").alias(c) for c in MD.NUMERIC_FEATURES if c != "rsi_14"])


def test_boosting_finds_a_planted_signal_among_200_industries(spark):
    df = _signal(spark).persist()
    p = MD.BoostParams(max_iter=24, patience=12, max_depth=3, step_size=0.05)
    fit = MD.train_final(df, p)
    assert fit["metrics"].first().auc > 0.85
    assert fit["model"].model.best > 6 and fit["top"].first().feature == "rsi_14"
    again = MD.train_final(df, p)["metrics"].first()
    assert again == fit["metrics"].first()
    new = df.limit(1).withColumn("industry", F.lit("never seen")).withColumn("sector", F.lit(None).cast("string"))
    assert MD.score_latest(new, fit["model"], "r", "d").count() == 1
    codes = fit["model"].bins.codes(pa.RecordBatch.from_pylist([r.asDict() for r in MD.model_frame(new).collect()],
                                                               schema=pa.schema([(n, pa.float64()) for n in MD.NUMERIC_FEATURES] + [(c, pa.string()) for c in MD.CATEGORICAL])))
    assert codes[0, -2:].tolist() == [7, 200]                 # neither was in training, nor was 'Unknown': the missing bin
