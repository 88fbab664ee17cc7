"""Registered queries: name -> (Spark builder, DuckDB twin SQL or None).

Every builder reads the driver tables of ``sf_dir`` (through the fixture
adapter), so its work grows with them.  ``__spark_entry__`` exposes this
catalog to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise import sql_twins as T
from barwise import sql_twins_ops as TO
from barwise.operators import modelprep as MP
from barwise.operators import snapshots as SN
from barwise.operators import summaries as S
from barwise.operators import universe as U
from barwise.operators.upsert import upsert_stats, write_snapshot
from barwise.plans import features as FE
from barwise.plans import ingest as IN
from barwise.plans import jobs as JB
from barwise.plans import model as MD
from barwise.plans import registry as RG
from barwise.schemas import DIVIDENDS
from barwise.session import scratch, scratch_path, written
from barwise.sources import fixtures as FX

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def fixture_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "bars": FX.price_history(spark, sf_dir),
        "fundamentals": FX.fundamentals(spark, sf_dir),
        "dividends": FX.dividends(spark, sf_dir),
        "splits": FX.splits(spark, sf_dir),
        "registry": FX.symbol_registry(spark, sf_dir),
    }


def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixture_inputs(spark, sf_dir)
    return FE.build_features(t["bars"], t["fundamentals"], t["dividends"], t["splits"],
                             U.equity_universe(t["registry"]))


# ---- sources -----------------------------------------------------------------
register("bars", FX.FIXTURE_SQL["price_history"])(lambda spark, d: FX.price_history(spark, d))
register("dividends", FX.FIXTURE_SQL["dividends"])(lambda spark, d: FX.dividends(spark, d))
register("splits", FX.FIXTURE_SQL["splits"])(lambda spark, d: FX.splits(spark, d))
register("fundamentals", FX.FIXTURE_SQL["fundamentals"])(lambda spark, d: FX.fundamentals(spark, d))
register("symbol_registry", FX.FIXTURE_SQL["symbol_registry"])(lambda spark, d: FX.symbol_registry(spark, d))

# ---- the feature build and its column groups ------------------------------------
FEATURE_GROUPS = {
    "features": FE.FEATURE_COLS,
    "feat_returns": ["symbol", "date", "daily_return", "log_return", "weekly_return", "monthly_return"],
    "feat_moving_averages": ["symbol", "date", "sma_5", "sma_10", "sma_20", "sma_50", "sma_200"],
    "feat_ema_macd": ["symbol", "date", "ema_12", "ema_26", "macd", "macd_signal", "macd_hist"],
    "feat_rsi": ["symbol", "date", "rsi_14"],
    "feat_bollinger": ["symbol", "date", "bb_upper", "bb_lower", "bb_width", "bb_pct"],
    "feat_atr_stochastic": ["symbol", "date", "atr_14", "stoch_k", "stoch_d"],
    "feat_volume": ["symbol", "date", "volume_sma_20", "volume_ratio"],
    "feat_volatility": ["symbol", "date", "rolling_std_5", "rolling_std_20"],
    "feat_52w_levels": ["symbol", "date", "high_52w", "low_52w", "pct_from_52w_high", "pct_from_52w_low"],
    "feat_lags": ["symbol", "date", "close_lag_1", "close_lag_2", "close_lag_5",
                  "return_lag_1", "return_lag_2", "return_lag_5"],
    "feat_targets": ["symbol", "date", "target_return_1d", "target_return_5d",
                     "target_direction_1d", "target_direction_5d"],
    "feat_fundamentals_asof": ["symbol", "date"] + FE.FUNDAMENTAL_COLS,
    "feat_events": ["symbol", "date", "dividend_yield_ttm", "days_since_dividend", "days_since_split",
                    "sector", "industry"],
}


def _feature_query(cols):
    def q(spark, d):
        return FE.round_features(feature_frame(spark, d).select(*cols))
    return q


for _name, _cols in FEATURE_GROUPS.items():
    register(_name, T.features_sql(_cols))(_feature_query(_cols))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}


# ---- registry refresh (C1) ---------------------------------------------------------


def registry_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return RG.refresh_registry(FX.symbol_registry(spark, sf_dir), FX.equity_master(spark, sf_dir),
                               FX.vendor_metadata(spark, sf_dir), FX.RUN_TS)


register("registry_equity_rows", TO.REGISTRY_SQL["registry_equity_rows"])(
    lambda spark, d: RG.equity_rows(FX.equity_master(spark, d), FX.RUN_TS))
register("registry_refresh", TO.REGISTRY_SQL["registry_refresh"])(
    lambda spark, d: registry_outputs(spark, d)["registry"])
register("registry_backlog", TO.REGISTRY_SQL["registry_backlog"])(
    lambda spark, d: registry_outputs(spark, d)["backlog"])
register("registry_summary", TO.REGISTRY_SQL["registry_summary"])(
    lambda spark, d: registry_outputs(spark, d)["summary"])
register("index_universe", TO.REGISTRY_SQL["index_universe"])(
    lambda spark, d: U.universe_or_fallback(U.index_universe(registry_outputs(spark, d)["registry"]),
                                            U.fallback_indices(spark)))
register("equity_universe", TO.REGISTRY_SQL["equity_universe"])(
    lambda spark, d: U.universe_or_fallback(U.equity_universe(registry_outputs(spark, d)["registry"]),
                                            U.fallback_equities(spark)))


# ---- ingestion (C2) ------------------------------------------------------------------
def ingest_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    uni = U.equity_universe(FX.symbol_registry(spark, sf_dir))
    ledger = FX.split_ledger(spark, sf_dir)
    price = IN.ingest(FX.stored_bars(spark, sf_dir), FX.bar_batch(spark, sf_dir), uni, ledger,
                      "price", FX.AS_OF, "run-1", FX.RUN_TS)
    div = IN.ingest(spark.createDataFrame([], DIVIDENDS), FX.dividends(spark, sf_dir), uni, ledger,
                    "dividend", FX.AS_OF, "run-1", FX.RUN_TS)
    return {"prices": price["table"], "ledger": price["ledger"].unionByName(div["ledger"]),
            "log": price["log"].unionByName(div["log"]), "universe": uni, "split_ledger": ledger}


register("ingest_prices", TO.INGEST_SQL["ingest_prices"])(lambda spark, d: ingest_outputs(spark, d)["prices"])
register("ingest_ledger", TO.INGEST_SQL["ingest_ledger"])(lambda spark, d: ingest_outputs(spark, d)["ledger"])
register("ingestion_summary", TO.INGEST_SQL["ingestion_summary"])(
    lambda spark, d: S.status_summary(ingest_outputs(spark, d)["log"], run_id="run-1"))


def _pending_splits(spark, d):
    o = ingest_outputs(spark, d)
    return U.pending(o["universe"], o["split_ledger"], "split", FX.AS_OF).select("yf_symbol")


register("pending_splits", TO.INGEST_SQL["pending_splits"])(_pending_splits)


# ---- model preparation, predictions, serving documents ---------------------------------------


LABEL = "target_direction_1d"


_STORED: dict[tuple[str, str], str] = {}


def rounded_features(spark: SparkSession, d: str) -> DataFrame:
    """The stored feature table of ``d``, as the training and read jobs use it: built once a session, laid out by
    symbol and date."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        path = scratch_path(spark, "stock-features")
        write_snapshot(FE.round_features(feature_frame(spark, d)), path, sort_within=["symbol", "date"])
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def _labelled(spark, d):
    return MP.labelled(rounded_features(spark, d), LABEL)


def _val_scores(spark, d):
    f = MP.walk_forward_folds(_labelled(spark, d)).where(F.col("split") == "val")
    return f.select("fold", F.col(LABEL).alias("y"),
                    F.coalesce(F.col("stoch_k") / 100, F.lit(0.5)).alias("prob"))


def _metrics(spark, d):
    return MP.classification_metrics(_val_scores(spark, d), "y", "prob", by=["fold"])


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def baseline_predictions(spark, d, score_col="stoch_k"):
    latest = S.latest_per_symbol(rounded_features(spark, d))
    p = latest.select("symbol", F.col("date").alias("feature_date"),
                      F.coalesce(F.col(score_col) / 100, F.lit(0.5)).alias("prob_up"))
    return MP.decide(p, "prob_up", "feature_date").select(
        "symbol", "feature_date", "prediction_date", "predicted_direction", "prob_up", "prob_down",
        F.lit("baseline").alias("mlflow_run_id"), F.lit("run-1").alias("dag_run_id"),
        F.lit(FX.RUN_TS).cast("timestamp_ntz").alias("created_at"))


def _two_runs(spark, d):
    """Predictions of this run, and those of an earlier run of the same model id."""
    old = baseline_predictions(spark, d, "stoch_d").where(F.col("predicted_direction") == 1)
    return baseline_predictions(spark, d).unionByName(old.withColumn("dag_run_id", F.lit("run-0")))


register("training_stats", TO.MODEL_SQL["training_stats"])(
    lambda spark, d: _r6(S.training_stats(rounded_features(spark, d), LABEL), ["up_share"]))
register("walk_forward_folds", TO.MODEL_SQL["walk_forward_folds"])(
    lambda spark, d: MP.walk_forward_folds(_labelled(spark, d)).groupBy("fold", "split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.min("date").alias("min_date"),
        F.max("date").alias("max_date"), F.sum(LABEL).cast("bigint").alias("n_up")))
register("holdout_split", TO.MODEL_SQL["holdout_split"])(
    lambda spark, d: MP.holdout_split(_labelled(spark, d)).groupBy("split", "cutoff_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.min("date").alias("min_date"),
        F.max("date").alias("max_date")))
register("encode_categories", TO.MODEL_SQL["encode_categories"])(
    lambda spark, d: MP.encode_categories(rounded_features(spark, d).select("symbol", "date", "sector", "industry")))
register("latest_features", TO.MODEL_SQL["latest_features"])(
    lambda spark, d: S.latest_per_symbol(rounded_features(spark, d)).select(
        "symbol", "date", "close_lag_1", "sma_20", "rsi_14", "stoch_k", LABEL))
register("fold_metrics", TO.MODEL_SQL["fold_metrics"])(
    lambda spark, d: _r6(_metrics(spark, d), ["accuracy", "auc", "f1", "logloss"]))
register("cv_average", TO.MODEL_SQL["cv_average"])(
    lambda spark, d: _r6(S.cv_average(_metrics(spark, d)), ["cv_accuracy", "cv_auc", "cv_f1", "cv_logloss"]))
register("predictions", TO.MODEL_SQL["predictions"])(
    lambda spark, d: _r6(baseline_predictions(spark, d), ["prob_up", "prob_down"]))
register("prediction_summary", TO.MODEL_SQL["prediction_summary"])(
    lambda spark, d: S.prediction_summary(_two_runs(spark, d), "run-1"))


register("prediction_documents", TO.MODEL_SQL["prediction_documents"])(
    lambda spark, d: JB.prediction_documents(baseline_predictions(spark, d)))


def _doc_stats(spark, d):
    cur = baseline_predictions(spark, d)
    prev = baseline_predictions(spark, d, "stoch_d").join(
        FX.dividends(spark, d).select("symbol").distinct(), "symbol", "left_semi")
    return upsert_stats(prev, cur, ["symbol", "feature_date"],
                        ["prediction_date", "predicted_direction", "prob_up", "prob_down"])


register("document_upsert_stats", TO.MODEL_SQL["document_upsert_stats"])(_doc_stats)

_READ_COLS = ["symbol", "date", "close_lag_1", "sma_20", "rsi_14", "daily_return"]
register("symbol_history", TO.MODEL_SQL["symbol_history"])(
    lambda spark, d: rounded_features(spark, d).where(F.col("symbol") == "Brand#13").select(*_READ_COLS))
register("date_snapshot", TO.MODEL_SQL["date_snapshot"])(
    lambda spark, d: rounded_features(spark, d).where(F.col("date") == F.lit("1998-06-15").cast("date"))
    .select(*_READ_COLS))


# ---- feature-run bookkeeping (F20 quarantine, U11, G3, G4, G9) ----------------------------------
def feature_log(spark, d):
    return JB.feature_log(FE.to_feature_schema(feature_frame(spark, d), computed_at=None), "run-1", FX.RUN_TS)


register("feature_run_log", TO.BOOK_SQL["feature_run_log"])(feature_log)
register("feature_summary", TO.BOOK_SQL["feature_summary"])(
    lambda spark, d: S.status_summary(feature_log(spark, d), "run-1", "features", by=("status",)))
register("feature_symbols", TO.BOOK_SQL["feature_symbols"])(
    lambda spark, d: S.distinct_symbols(feature_log(spark, d).where(F.col("status") == "success")))


# ---- training and scoring (no SQL twin: rows-only check) -------------------------------------


_TRAINED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def trained(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """One training run of the job over ``d`` for all queries of a session: cross-validation and final fit (C4), the
    model saved and loaded again (M13), the newest rows scored (C5), the run row (M16) and the importance file (U14)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TRAINED:
        with scratch(spark) as keep:
            feats = rounded_features(spark, d)
            fit = MD.train_and_predict(feats, run_id="gbt-run", created_at=FX.RUN_TS)
            base = scratch_path(spark, "models")
            MD.save_model(spark, fit["model"], base, "gbt-run")
            JB.write_importance_csv(fit["importance"], f"{base}/importance")
            pred = MD.score_latest(feats, MD.load_model(spark, base, "gbt-run"), "gbt-run", "run-1", FX.RUN_TS)
            _TRAINED[key] = {"predictions": keep(written(pred, "predictions")), "run": keep(written(fit["run"], "run")),
                             "importance": spark.read.schema(fit["importance"].schema).option("header", True).csv(f"{base}/importance"),
                             "folds": keep(written(fit["cv"]["folds"], "folds"))}
    return _TRAINED[key]


register("gbt_predictions", None)(lambda spark, d: trained(spark, d)["predictions"])
register("gbt_feature_importance", None)(lambda spark, d: trained(spark, d)["importance"])
register("gbt_folds", None)(lambda spark, d: trained(spark, d)["folds"])
register("model_run", None)(lambda spark, d: trained(spark, d)["run"])


# ---- many short series: one symbol per supplier (FIXTURES §2 note) ----------------------------
register("features_by_supplier", T.features_sql(symbol_col="l_suppkey"))(
    lambda spark, d: FE.round_features(FE.build_features(FX.price_history(spark, d, "l_suppkey"))))


# ---- event-table ingestion (U2-U4): refetched batch merged into the stored table -------------
def event_ingest(spark, d, kind):
    name = FX.EVENT_TABLES[kind][0]
    batch = {"dividends": FX.dividends, "splits": FX.splits, "fundamentals": FX.fundamentals}[name](spark, d)
    uni = U.equity_universe(FX.symbol_registry(spark, d))
    return IN.ingest(FX.stored_events(spark, d, kind), batch, uni, FX.split_ledger(spark, d), kind,
                     FX.AS_OF, "run-1", FX.RUN_TS)["table"]


for _kind in ("dividend", "split", "fundamental"):
    register(f"ingest_{_kind}s", TO.event_ingest_sql(_kind))(
        lambda spark, d, _k=_kind: event_ingest(spark, d, _k))


# ---- rarer branches: P2, P3, P6, P7, F9, F16, F20, R3 ------------------------------------------------
def _messy(spark, d, bars):
    t = fixture_inputs(spark, d)
    return FE.build_features(bars, t["fundamentals"], t["dividends"], t["splits"], U.equity_universe(t["registry"]))


register("features_messy", TO.BRANCH_SQL["features_messy"])(
    lambda spark, d: FE.round_features(_messy(spark, d, FX.messy_bars(spark, d))))
register("quarantine_log", TO.BRANCH_SQL["quarantine_log"])(
    lambda spark, d: JB.feature_log(FE.to_feature_schema(_messy(spark, d, FX.spiked_bars(spark, d)), computed_at=None), "run-1", FX.RUN_TS))
register("marked_equities", TO.BRANCH_SQL["marked_equities"])(lambda spark, d: U.equity_universe(FX.marked_registry(spark, d)))
register("marked_indices", TO.BRANCH_SQL["marked_indices"])(lambda spark, d: U.index_universe(FX.marked_registry(spark, d)))


def _enriched(spark, d):
    reg = FX.marked_registry(spark, d)
    return RG.enrich(reg, U.enrichment_backlog(reg), FX.vendor_metadata(spark, d), FX.RUN_TS)


register("registry_enriched", TO.BRANCH_SQL["registry_enriched"])(_enriched)
register("backlog_newest", TO.BRANCH_SQL["backlog_newest"])(
    lambda spark, d: U.enrichment_backlog(FX.marked_registry(spark, d), 5).select("symbol", "listing_date"))


# ---- writing jobs into versioned tables: U5, U6, C6 --------------------------------------------------
_OLD = "2000-01-01 00:00:00"


def _stamp(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def features_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A day's features over a stored table: matched rows are replaced and touched, the others stay."""
    with scratch(spark):
        ff = rounded_features(spark, d).select("symbol", "date", "sma_20", "rsi_14")
        table, minus = scratch_path(spark, "stock-features"), F.lit(-1.0)
        stored = ff.where(F.col("date") < F.lit("1999-01-01").cast("date")).select(
            "symbol", "date", minus.alias("sma_20"), minus.alias("rsi_14"), _stamp(_OLD).alias("computed_at"))
        SN.replace(spark, table, stored, ["symbol", "date"], F.date_format("date", "yyyy-MM"))
        batch = ff.where(F.col("symbol") != "Brand#13").withColumn("computed_at", _stamp(FX.RUN_TS))
        SN.merge(spark, table, batch, ["symbol", "date"], ["sma_20", "rsi_14"], "date", touch={"computed_at": _stamp(FX.RUN_TS)})
    return SN.read(spark, table)


def _scored_before(spark, d):
    """The predictions and documents of an earlier run, for the symbols with dividends."""
    return baseline_predictions(spark, d, "stoch_d").join(FX.dividends(spark, d).select("symbol").distinct(), "symbol", "left_semi")


def predictions_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Rescored rows take the new values and keep the time of their first insert."""
    table = scratch_path(spark, "stock-predictions")
    JB.run_prediction_job(spark, _scored_before(spark, d).withColumn("created_at", _stamp(_OLD)), table, "run-0")
    now = JB.run_prediction_job(spark, baseline_predictions(spark, d), table, "run-1")["predictions"]
    return _r6(now, ["prob_up", "prob_down"])


def documents_synced(spark: SparkSession, d: str) -> DataFrame:
    """The serving table after a second sync."""
    table = scratch_path(spark, "documents")
    JB.run_sync_job(spark, JB.prediction_documents(_scored_before(spark, d)), table)
    return JB.run_sync_job(spark, JB.prediction_documents(baseline_predictions(spark, d)), table)["documents"]


register("features_upsert", TO.BRANCH_SQL["features_upsert"])(features_upsert)
register("predictions_upsert", TO.BRANCH_SQL["predictions_upsert"])(predictions_upsert)
register("documents_synced", TO.BRANCH_SQL["documents_synced"])(documents_synced)
