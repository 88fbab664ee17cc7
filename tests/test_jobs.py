import tempfile

from pyspark.sql import functions as F

from barwise import catalog
from barwise.operators import universe as U
from barwise.plans.jobs import prediction_documents, run_feature_job, run_prediction_job, run_sync_job

SF_SMALL = "/root/testdata/sf0.001"


def test_feature_prediction_sync_jobs(spark):
    root = tempfile.mkdtemp(prefix="barwise-jobs-")
    t = catalog.fixture_inputs(spark, SF_SMALL)
    uni = U.equity_universe(t["registry"])
    args = (t["bars"], t["fundamentals"], t["dividends"], t["splits"], uni)
    r1 = run_feature_job(spark, *args, f"{root}/features", f"{root}/log", "r1", "2025-01-05 00:00:00")
    n1 = r1["features"].count()
    assert n1 > 0
    r2 = run_feature_job(spark, *args, f"{root}/features", f"{root}/log", "r2", "2025-01-06 00:00:00")
    assert r2["features"].count() == n1                                    # idempotent upsert
    assert r2["features"].where(F.col("computed_at") != F.lit("2025-01-06 00:00:00").cast("timestamp_ntz")).count() == 0
    s = {r.status: r.n for r in r2["summary"].collect()}
    assert sum(s.values()) == 25                                          # one log row per symbol

    pred = catalog.baseline_predictions(spark, SF_SMALL)
    p1 = run_prediction_job(spark, pred, f"{root}/predictions", "run-1")
    assert p1["summary"].first().total == p1["predictions"].count()
    docs = prediction_documents(p1["predictions"])
    d1 = run_sync_job(spark, docs, f"{root}/docs")
    assert d1["stats"].first().inserted == docs.count()
    d2 = run_sync_job(spark, docs, f"{root}/docs")
    st = d2["stats"].first()
    assert (st.inserted, st.modified) == (0, 0) and d2["documents"].count() == docs.count()
