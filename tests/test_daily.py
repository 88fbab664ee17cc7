import datetime as dt

from pyspark.sql import functions as F

from barwise import catalog
from barwise.operators import snapshots as S
from barwise.operators.branches import run_branches
from barwise.operators.universe import equity_universe
from barwise.plans import features as FE
from barwise.plans.daily import run_daily
from barwise.plans.model import BoostParams
from barwise.sources import fixtures as FX

SF_SMALL = "/root/testdata/sf0.001"


def test_daily_runs_end_to_end(spark, tmp_path):
    t = catalog.fixture_inputs(spark, SF_SMALL)
    landing = {"registry": t["registry"], "master": FX.equity_master(spark, SF_SMALL),
               "meta": FX.vendor_metadata(spark, SF_SMALL), "bars": t["bars"], "dividends": t["dividends"],
               "splits": t["splits"], "fundamentals": t["fundamentals"]}
    root, small = str(tmp_path), BoostParams(max_iter=3, patience=2)
    newest = lambda name: S.version(spark, f"{root}/{name}")
    read = lambda name, v: S.read(spark, f"{root}/{name}", v.number)
    out = run_daily(spark, landing, root, "daily-1", FX.AS_OF, FX.RUN_TS, small)
    ing = {(r.data_type, r.status): r.n for r in out["ingestion"].collect()}
    # the nine fallback indices have no prices in the landing data: logged as failed
    assert ing[("price", "success")] == 25 and ing[("price", "failed")] == 9 and ing[("features", "success")] == 25
    assert out["predictions"].first().total == 25 and out["run"].first().cv_auc_roc is not None
    s = out["sync"].first()
    assert (s.inserted, s.modified, s.total) == (25, 0, 25)
    # the five branches ran at the same time
    assert len(out["branches"]) == 5 and max(b.started for b in out["branches"].values()) < min(b.ended for b in out["branches"].values())
    bars1, pred1, feats1 = newest("bars"), newest("stock_predictions"), newest("stock_features")

    # a second run of the same day skips what the ledger has as done and keeps first-insert times; a branch that fails ends alone
    landing["bars"] = t["bars"].withColumn("close", F.col("close") + 1)
    landing["splits"] = t["splits"].withColumn("ratio", F.raise_error(F.lit("unreadable feed")).cast("double"))
    again = run_daily(spark, landing, root, "daily-2", FX.AS_OF, "2030-01-01 00:00:00", small)
    ing = {(r.data_type, r.status): r.n for r in again["ingestion"].collect()}
    assert ("price", "success") not in ing and ing[("price", "failed")] == 9
    bars2 = newest("bars")
    assert bars2.files == bars1.files and newest("stock_features").files == feats1.files      # no input row changed
    assert read("stock_predictions", newest("stock_predictions")).where("created_at >= '2030-01-01'").isEmpty() and newest("stock_predictions").number > pred1.number
    assert read("model_runs", newest("model_runs")).count() == 2 and again["predictions"].first().total == 25

    # the next day brings one day's bars: the files of its month are rewritten, the time of the first insert stays
    day = dt.date(1998, 6, 15)
    day = t["bars"].where(F.col("date") <= day).agg(F.max("date")).first()[0]
    landing["bars"] = t["bars"].where(F.col("date") == day).withColumn("close", F.col("close") + 1)
    last = run_daily(spark, landing, root, "daily-3", "2030-01-02", "2030-01-02 00:00:00", small)
    assert not last["branches"]["splits"].ok and "unreadable" in str(last["branches"]["splits"].error)
    assert sum(b.ok for b in last["branches"].values()) == 4 and {(r.data_type, r.status) for r in last["ingestion"].collect()} >= {("split", "failed")}
    bars3 = newest("bars")
    assert {f.part for f in set(bars2.files) ^ set(bars3.files)} == {day.strftime("%Y-%m")}
    rebuilt = {f.part for f in set(feats1.files) ^ set(newest("stock_features").files)}
    assert rebuilt and min(rebuilt) >= (day - dt.timedelta(days=400)).strftime("%Y-%m") > min(f.part for f in feats1.files)
    whole = FE.to_feature_schema(FE.build_features(*(read(n, newest(n)) for n in ("bars", "fundamentals", "dividends", "splits")),
                                                   equity_universe(read("registry", newest("registry"))))).where("_status = 'success'").select(FE.FEATURE_COLS)
    now = read("stock_features", newest("stock_features")).select(FE.FEATURE_COLS)
    assert whole.exceptAll(now).isEmpty() and now.exceptAll(whole).isEmpty()
    both = read("bars", bars2).alias("a").join(read("bars", bars3).alias("b"), ["symbol", "date"])
    changed = both.where("b.close = a.close + 1 and a.ingested_at = b.ingested_at")
    assert both.count() == sum(f.rows for f in bars1.files) and changed.count() == landing["bars"].count() == changed.where(F.col("date") == day).count() > 0


def test_a_failing_branch_does_not_end_the_others(spark):
    def fail():
        spark.range(5).select(F.raise_error(F.lit("no"))).collect()
    out = run_branches(spark, {"a": lambda: spark.range(7).count(), "b": fail, "c": lambda: 3})
    assert out["a"].result == 7 and out["c"].result == 3 and not out["b"].ok and "no" in str(out["b"].error)
