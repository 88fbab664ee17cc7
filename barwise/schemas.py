"""Fixed table schemas (U15).  Natural keys are kept; surrogate ids are not.
Timestamps are wall-clock (TIMESTAMP without time zone): TimestampNTZType."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(), "int": T.IntegerType(),
          "bigint": T.LongType(), "smallint": T.ShortType(), "boolean": T.BooleanType(),
          "timestamp": T.TimestampNTZType()}


def _s(ddl: str) -> T.StructType:
    """``"name type, ..."`` -> StructType (no session needed at import)."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


REGISTRY = _s("symbol string, yf_symbol string, name string, symbol_type string, index_category string, "
              "sector string, industry string, isin string, series string, listing_date date, "
              "face_value double, paid_up_value double, market_lot int, is_active boolean, "
              "last_updated timestamp, highlight boolean")
PRICE_HISTORY = _s("symbol string, date date, open double, high double, low double, close double, "
                   "adj_close double, volume bigint, ingested_at timestamp")
DIVIDENDS = _s("symbol string, ex_date date, amount double, ingested_at timestamp")
SPLITS = _s("symbol string, split_date date, ratio double, ingested_at timestamp")
FUNDAMENTALS = _s("symbol string, as_of_date date, pe_ratio double, pb_ratio double, eps double, "
                  "revenue bigint, net_income bigint, debt_to_equity double, roe double, market_cap bigint, "
                  "ingested_at timestamp")
INGESTION_DELTA = _s("symbol string, data_type string, data_from date, data_to date, start_time timestamp, "
                     "end_time timestamp, status string, record_count bigint, error_msg string, "
                     "dag_run_id string, created_at timestamp")
INGESTION_LOG = _s("symbol string, data_type string, status string, rows_affected bigint, error_msg string, "
                   "dag_run_id string, ran_at timestamp")
MODEL_RUNS = _s("mlflow_run_id string, model_version string, dag_run_id string, train_from date, train_to date, "
                "val_from date, val_to date, n_train_rows bigint, n_val_rows bigint, n_features int, "
                "cv_accuracy double, cv_auc_roc double, cv_f1 double, cv_log_loss double, val_accuracy double, "
                "val_auc_roc double, val_f1 double, val_log_loss double, created_at timestamp")
PREDICTIONS = _s("symbol string, feature_date date, prediction_date date, predicted_direction smallint, "
                 "prob_up double, prob_down double, mlflow_run_id string, dag_run_id string, created_at timestamp")
