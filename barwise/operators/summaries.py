"""Aggregations of the audit trail, ledgers, registry and training data
(G1-G9) and the ranking helpers (R1-R7).  All aggregate map-side before
their shuffle; those over a whole row (a struct) are sort aggregates, which
spill, the others hash aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def registry_summary(reg: DataFrame) -> DataFrame:
    """G1: active symbols by (type, category): total and with sector."""
    return (reg.where(F.col("is_active"))
               .groupBy("symbol_type", "index_category")
               .agg(F.count(F.lit(1)).cast("bigint").alias("total"),
                    F.count("sector").cast("bigint").alias("with_sector"))
               .orderBy("symbol_type", "index_category"))


def status_summary(log: DataFrame, run_id: str | None = None, data_type: str | None = None,
                   by: tuple[str, ...] = ("data_type", "status")) -> DataFrame:
    """Rows and affected rows by (data_type, status) for a run."""
    if run_id is not None:
        log = log.where(F.col("dag_run_id") == run_id)
    if data_type is not None:
        log = log.where(F.col("data_type") == data_type)
    return (log.groupBy(*by)
               .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                    F.coalesce(F.sum("rows_affected"), F.lit(0)).cast("bigint").alias("rows"))
               .orderBy(*by))


def distinct_symbols(df: DataFrame, col: str = "symbol") -> DataFrame:
    """Number of distinct symbols."""
    return df.agg(F.countDistinct(col).cast("bigint").alias("n_symbols"))


def training_stats(df: DataFrame, label: str = "target_direction_1d") -> DataFrame:
    """Labelled rows, symbols, date range and the up share (0-guarded)."""
    lab = df.where(F.col(label).isNotNull())
    return lab.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.countDistinct("symbol").cast("bigint").alias("n_symbols"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        (F.sum(F.col(label).cast("double")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("up_share"),
    )


def require_rows(stats: DataFrame, minimum: int = 1000) -> int:
    """Fail the run when fewer than ``minimum`` labelled rows exist.
    Collects ONE aggregated row."""
    n = stats.select("n_rows").first()[0] or 0
    if n < minimum:
        raise ValueError(f"only {n} labelled rows; need at least {minimum}")
    return n


def coverage(df: DataFrame, date_col: str = "date", key: str = "symbol") -> DataFrame:
    """Per-key first date, last date and row count."""
    return df.groupBy(key).agg(F.min(date_col).alias("data_from"), F.max(date_col).alias("data_to"),
                               F.count(F.lit(1)).cast("bigint").alias("record_count"))


def prediction_summary(pred: DataFrame, run_id: str | None = None) -> DataFrame:
    """Total, up and down predictions of a run (its ``dag_run_id``)."""
    if run_id is not None:
        pred = pred.where(F.col("dag_run_id") == run_id)
    d = F.col("predicted_direction")
    return pred.agg(F.count(F.lit(1)).cast("bigint").alias("total"),
                    F.count(F.when(d == 1, 1)).cast("bigint").alias("up"),
                    F.count(F.when(d == 0, 1)).cast("bigint").alias("down"))


def cv_average(folds: DataFrame, metrics=("accuracy", "auc", "f1", "logloss")) -> DataFrame:
    """Mean of the fold metrics."""
    return folds.agg(*[F.avg(m).alias(f"cv_{m}") for m in metrics])


# ---- ranking ---------------------------------------------------------------------

def latest_per_symbol(df: DataFrame, key: str = "symbol", order_col: str = "date") -> DataFrame:
    """Newest row per key (``DISTINCT ON ... ORDER BY date DESC``) as a
    ``max_by`` aggregate over the whole row: partial aggregation keeps at
    most one row per key and partition before the shuffle."""
    others = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("__r"))
              .select(key, "__r.*"))


def latest_run(runs: DataFrame, run_id: str, order_col: str = "created_at") -> DataFrame:
    """R2: the newest row of one run id (ORDER BY ... LIMIT 1)."""
    return runs.where(F.col("dag_run_id") == run_id).orderBy(F.col(order_col).desc()).limit(1)


def top_k(df: DataFrame, by: str, k: int, tie: str | None = None) -> DataFrame:
    """Top-k by a column (TakeOrderedAndProject: per-partition top-k
    then a k-row merge — never a full sort)."""
    order = [F.col(by).desc()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*order).limit(k)


def date_index(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Distinct dates with their 0-based chronological index.

    The distinct set is bounded by the calendar (one row per trading day),
    so the global ``row_number`` over it is a few thousand rows even when the
    fact table is huge."""
    d = df.select(date_col).distinct()
    return d.withColumn("date_idx", F.row_number().over(Window.orderBy(date_col)) - 1) \
            .withColumn("n_dates", F.count(F.lit(1)).over(Window.partitionBy()))
