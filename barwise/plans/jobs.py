"""End-to-end jobs that write their outputs (C3 write path, C5, C6, U5, U6,
U10-U14).

Tables are versioned (:mod:`barwise.operators.snapshots`).  Each job computes
its result once into a staged table (which also cuts the lineage), merges it into
the stored table as one version (the files it touches, all or nothing) and derives
the audit rows from the staged data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.operators import snapshots
from barwise.operators.summaries import prediction_summary, status_summary
from barwise.operators.upsert import upsert_stats
from barwise.plans.features import FEATURE_COLS, build_features, to_feature_schema
from barwise.session import scratch, written

PRED_KEYS = ["symbol", "feature_date"]
# a rescored row keeps the created_at of its first insert
PRED_UPDATE = ["prediction_date", "predicted_direction", "prob_up", "prob_down", "mlflow_run_id", "dag_run_id"]


def write_importance_csv(importance: DataFrame, path: str) -> None:
    """The importance of every feature (one row each) as one CSV file."""
    importance.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def feature_log(staged: DataFrame, run_id: str, ran_at) -> DataFrame:
    """One audit row per symbol of a staged feature table; a quarantined symbol counts no rows."""
    bad = F.col("_status") == "failed"
    return (staged.groupBy("symbol", "_status").agg(F.count(F.lit(1)).alias("n"))
            .select("symbol", F.lit("features").alias("data_type"), F.col("_status").alias("status"),
                    F.when(bad, 0).otherwise(F.col("n")).cast("bigint").alias("rows_affected"),
                    F.when(bad, F.lit("numeric overflow")).alias("error_msg"),
                    F.lit(run_id).alias("dag_run_id"), F.lit(ran_at).cast("timestamp_ntz").alias("ran_at")))


def run_feature_job(spark: SparkSession, bars: DataFrame, fundamentals: DataFrame, dividends: DataFrame,
                    splits: DataFrame, universe: DataFrame, table: str, log_table: str, run_id: str, computed_at) -> dict[str, DataFrame]:
    """C3 + F20 + U5 + U11 + G3: features of all symbols, quarantined symbols logged 'failed', the rest merged into
    ``table`` (touching computed_at)."""
    with scratch(spark):
        staged = written(to_feature_schema(build_features(bars, fundamentals, dividends, splits, universe), computed_at), "features-staged")
        ok = staged.where(F.col("_status") == "success").drop("_status")
        upd = [c for c in FEATURE_COLS if c not in ("symbol", "date")]
        snapshots.merge(spark, table, ok, ["symbol", "date"], upd, "date", touch={"computed_at": F.lit(computed_at).cast("timestamp_ntz")})
        snapshots.append(spark, log_table, feature_log(staged, run_id, computed_at))
    return {"features": snapshots.read(spark, table),
            "summary": status_summary(snapshots.read(spark, log_table), run_id, "features", by=("status",))}


def run_prediction_job(spark: SparkSession, predictions: DataFrame, table: str, dag_run_id: str) -> dict[str, DataFrame]:
    """C5 tail: U6 keyed upsert of the scored rows, G7 summary."""
    snapshots.merge(spark, table, predictions, PRED_KEYS, PRED_UPDATE, "feature_date")
    now = snapshots.read(spark, table)
    return {"predictions": now, "summary": prediction_summary(now, dag_run_id)}


def prediction_documents(pred: DataFrame) -> DataFrame:
    """Serving documents — dates and timestamps as text, ints,
    floats — newest feature date first, then symbol."""
    return pred.select("symbol", F.col("feature_date").cast("string").alias("feature_date"),
                       F.col("prediction_date").cast("string").alias("prediction_date"),
                       F.col("predicted_direction").cast("int").alias("predicted_direction"),
                       F.round("prob_up", 6).alias("prob_up"), F.round("prob_down", 6).alias("prob_down"),
                       "mlflow_run_id", "dag_run_id", F.col("created_at").cast("string").alias("created_at")) \
               .orderBy(F.col("feature_date").desc(), F.col("symbol").asc())


def run_sync_job(spark: SparkSession, documents: DataFrame, table: str) -> dict[str, DataFrame]:
    """U10 — documents merged into the serving table keyed by (symbol, feature_date); inserted / modified /
    total counts."""
    fields = [c for c in documents.columns if c not in PRED_KEYS]
    with scratch(spark):
        batch = written(documents, "documents")
        stored = snapshots.read(spark, table) if snapshots.exists(spark, table) else batch.limit(0)
        stats = upsert_stats(stored, batch, PRED_KEYS, fields)
        stats_rows = stats.collect()          # one aggregated row
        snapshots.merge(spark, table, batch, PRED_KEYS, fields, "feature_date")
    return {"documents": snapshots.read(spark, table), "stats": spark.createDataFrame(stats_rows, stats.schema)}
