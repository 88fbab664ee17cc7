import datetime as dt
import os
import tempfile

import pandas as pd

import __spark_entry__ as E
from barwise.schemas import PRICE_HISTORY
from barwise.streaming.ingest_stream import latest_table, start_bar_ingestion


def test_file_stream_upserts_bars(spark):
    root = tempfile.mkdtemp(prefix="barwise-stream-")
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    d = pd.Timestamp("2024-01-02")
    pd.DataFrame({"symbol": ["A", "A"], "Date": [d, d + pd.Timedelta(days=1)], "Open": [1.0, 2.0],
                  "High": [1.0, 2.0], "Low": [1.0, 2.0], "Close": [1.0, None], "Adj Close": [1.0, 2.0],
                  "Volume": [None, 5.0]}).to_parquet(os.path.join(landing, "a1.parquet"), coerce_timestamps="us")
    base = spark.createDataFrame([], PRICE_HISTORY)
    q = start_bar_ingestion(spark, landing, base, os.path.join(root, "table"), os.path.join(root, "ckpt"),
                            "2025-01-05 00:00:00")
    q.awaitTermination(120)
    rows = latest_table(spark, os.path.join(root, "table"), base).collect()
    assert len(rows) == 1 and rows[0].volume == 0          # NULL close dropped, NULL volume -> 0
    pd.DataFrame({"symbol": ["A"], "Date": [d], "Open": [1.5], "High": [1.5], "Low": [1.5], "Close": [1.5],
                  "Adj Close": [1.5], "Volume": [7.0]}).to_parquet(os.path.join(landing, "a2.parquet"), coerce_timestamps="us")
    q = start_bar_ingestion(spark, landing, base, os.path.join(root, "table"), os.path.join(root, "ckpt"),
                            "2025-01-06 00:00:00")
    q.awaitTermination(120)
    rows = latest_table(spark, os.path.join(root, "table"), base).collect()
    assert len(rows) == 1 and rows[0].close == 1.5 and rows[0].volume == 7
    assert rows[0].ingested_at == dt.datetime(2025, 1, 5)   # kept from the first insert


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["symbol", "date"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert {k for k in qs if k not in sql and k != "pipeline" and not k.startswith("op")} == {"gbt_predictions", "gbt_feature_importance", "gbt_folds", "model_run"}
