import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from barwise.functions import next_business_day
from barwise.operators.modelprep import FOLD_BOUNDARIES, classification_metrics, roc_auc, walk_forward_folds
from barwise.plans.registry import equity_rows, index_catalog, read_equity_master

D = dt.date


def test_master_parse_edge_cases(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="barwise-csv-"), "eq.csv")
    with open(path, "w") as fh:
        fh.write(" SYMBOL,NAME OF COMPANY , SERIES,DATE OF LISTING,PAID UP VALUE,MARKET LOT,ISIN NUMBER,FACE VALUE\n")
        fh.write("ABC,Abc Ltd,EQ,06-OCT-2008,10,1,INE1,10\n")
        fh.write("  ,Blank,EQ,06-OCT-2008,10,1,INE2,10\n")
        fh.write("XYZ,Xyz Ltd,BE,garbage,x,,INE3,abc\n")
        fh.write("LOT0,Zero lot,EQ,15/01/2001,5,0,INE4,2\n")
    m = read_equity_master(spark, path)
    assert "SYMBOL" in m.columns and "NAME OF COMPANY" in m.columns
    rows = {r.symbol: r for r in equity_rows(m, "2025-01-05 00:00:00").collect()}
    assert set(rows) == {"ABC", "XYZ", "LOT0"}                                # blank symbol skipped
    assert rows["ABC"].listing_date == D(2008, 10, 6) and rows["ABC"].yf_symbol == "ABC.NS"
    assert rows["XYZ"].listing_date is None and rows["XYZ"].face_value is None
    assert rows["XYZ"].market_lot is None and rows["LOT0"].market_lot is None
    assert rows["LOT0"].listing_date == D(2001, 1, 15)


def test_index_catalog_has_three_groups(spark):
    cat = index_catalog(spark)
    assert cat.count() == 47
    assert {r[0] for r in cat.select("index_category").distinct().collect()} == \
        {"broad", "volatility", "currency", "sector", "thematic"}


def test_next_business_day(spark):
    df = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 6),), (D(2024, 1, 7),), (D(2024, 1, 8),)], "d date")
    got = [r[0] for r in df.select(next_business_day("d")).collect()]
    assert got == [D(2024, 1, 8), D(2024, 1, 8), D(2024, 1, 8), D(2024, 1, 9)]


def test_fold_cuts_use_float_arithmetic(spark):
    for n in (90, 170, 180):
        dates = [D(2000, 1, 1) + dt.timedelta(days=i) for i in range(n)]
        df = spark.createDataFrame([(d, "S") for d in dates], "date date, symbol string")
        f = walk_forward_folds(df)
        for fold, (_, te, ve) in enumerate(FOLD_BOUNDARIES, 1):
            tr = f.where((F.col("fold") == fold) & (F.col("split") == "train")).agg(F.max("date")).first()[0]
            va = f.where((F.col("fold") == fold) & (F.col("split") == "val")).agg(F.max("date")).first()[0]
            assert tr == dates[int(n * te) - 1] and va == dates[int(n * ve) - 1]
            assert f.where((F.col("fold") == fold) & (F.col("split") == "val") & (F.col("date") <= tr)).count() == 0


def _brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    if not pos or not neg:
        return None
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    ys = [1, 0, 1, 1, 0, 0, 1, 0, 1, 0, 0, 1]
    ps = [0.9, 0.9, 0.3, 0.5, 0.5, 0.1, 0.7, 0.7, 0.7, 0.2, 0.99, 0.0]
    df = spark.createDataFrame(list(zip(ys, ps)), "y int, prob double")
    got = roc_auc(df, "y", "prob").first()["auc"]
    assert abs(got - _brute_auc(ys, ps)) < 1e-12
    single = spark.createDataFrame([(1, 0.4), (1, 0.6)], "y int, prob double")
    assert roc_auc(single, "y", "prob").first()["auc"] is None
    m = classification_metrics(df, "y", "prob").first()
    assert 0 <= m.accuracy <= 1 and m.logloss > 0


def test_labelled_and_latest_run(spark):
    import datetime as _dt

    from barwise.operators.modelprep import labelled
    from barwise.operators.summaries import latest_run, top_k
    df = spark.createDataFrame([(1, None), (2, 1), (3, 0)], "k int, target_direction_1d smallint")
    assert sorted(r.k for r in labelled(df).collect()) == [2, 3]
    runs = spark.createDataFrame([("a", "r1", _dt.datetime(2025, 1, 1)), ("b", "r1", _dt.datetime(2025, 1, 2)),
                                  ("c", "r2", _dt.datetime(2025, 1, 3))],
                                 "mlflow_run_id string, dag_run_id string, created_at timestamp")
    assert latest_run(runs, "r1").first().mlflow_run_id == "b"
    imp = spark.createDataFrame([("x", 0.5), ("y", 0.5), ("z", 0.9)], "feature string, importance double")
    assert [r.feature for r in top_k(imp, "importance", 2, "feature").collect()] == ["z", "x"]
