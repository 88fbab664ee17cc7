"""C4/C5 — training and scoring.

The learner is :mod:`barwise.operators.boosting`: histogram trees grown best
leaf first with the job's budget (63 leaves, depth 6, step 0.05, up to 1000
rounds, 0.8 row and feature sampling, at least 50 rows a leaf, L1 and L2 of
0.1, seed 42, patience of 50 rounds).  The three walk-forward folds and the
final fit are trained together: each pass over the stored, binned rows serves
all four.  Missing values have their own bin and a learned direction (M6).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions import or_unknown, truncate_text
from barwise.operators.boosting import VAL, Bins, BoostParams, Model, Table, Tree, binned, fit_bins, fit_boosted, predicted
from barwise.operators.modelprep import FOLD_BOUNDARIES, HOLDOUT_FRACTION, classification_metrics, decide, labelled, split_roles
from barwise.operators.summaries import cv_average, latest_per_symbol, require_rows, top_k, training_stats
from barwise.operators.upsert import align_to_schema
from barwise.plans.features import NUMERIC_FEATURES
from barwise.schemas import MODEL_RUNS
from barwise.session import written

LABEL = "target_direction_1d"
CATEGORICAL = ["sector", "industry"]
MIN_TRAIN_ROWS = 1000


@dataclass
class Fitted:
    """A trained model with the bins of its features."""

    bins: Bins
    model: Model


def model_frame(df: DataFrame) -> DataFrame:
    """M1 + F17: numeric features as double (bad values NULL), categories with NULL -> 'Unknown', label as double."""
    cols = [F.col(c).try_cast("double").alias(c) for c in NUMERIC_FEATURES]
    cats = [or_unknown(c).alias(c) for c in CATEGORICAL]
    keep = [c for c in ("symbol", "date", "roles") if c in df.columns]
    lab = [F.col(LABEL).cast("double").alias("label")] if LABEL in df.columns else []
    return df.select(*keep, *cols, *cats, *lab)


@dataclass
class Run:
    """The models of one training run over ``data`` (a written table with ``roles``), in the order of the roles."""

    data: DataFrame
    bins: Bins
    table: Table
    models: list[Model]

    def scores(self) -> DataFrame:
        return written(self.table.scores(self.models), "scores")


def fit_together(features: DataFrame, p: BoostParams = BoostParams(), folds: bool = True, final: bool = True) -> Run:
    """One model per walk-forward fold and the 90/10 final fit, trained in the same passes.

    Bin borders come from the first fold's training rows, on which all of them train, so that no model
    sees its validation rows; trained apart they get the same bins, bags and trees."""
    cuts = [(end, stop) for _, end, stop in FOLD_BOUNDARIES]
    roles = split_roles(labelled(features, LABEL), [*cuts, (HOLDOUT_FRACTION, None)])
    data = written(model_frame(roles), "training")
    bins = fit_bins(data, NUMERIC_FEATURES, CATEGORICAL, "roles[0] = 1", p.max_bins)
    first, last = (0 if folds else len(cuts)), (len(cuts) + 1 if final else len(cuts))
    chosen = data.withColumn("roles", F.slice("roles", first + 1, last - first))
    table = binned(chosen, bins, "roles", last - first, "xxhash64(symbol, date)", "label")
    return Run(data, bins, table, fit_boosted(table, bins, p))


def _cv(scores: DataFrame) -> dict[str, DataFrame]:
    folds = scores.where(F.col("model") < len(FOLD_BOUNDARIES)).withColumn("fold", F.col("model") + 1)
    per_fold = classification_metrics(folds, "label", "prob_up", by=["fold"])
    return {"folds": per_fold, "cv": cv_average(per_fold)}


def cross_validate(features: DataFrame, p: BoostParams = BoostParams()) -> dict[str, DataFrame]:
    """Metrics per walk-forward fold (train rows fit, val rows stop early and are scored) and their mean."""
    return _cv(fit_together(features, p, final=False).scores())


def _final(run: Run, scores: DataFrame) -> dict:
    spark, fitted = run.data.sparkSession, Fitted(run.bins, run.models[-1])
    counts = fitted.model.split_counts(len(run.bins.names))
    importance = spark.createDataFrame([(n, float(c)) for n, c in zip(run.bins.names, counts)], "feature string, importance double")
    metrics = classification_metrics(scores.where(F.col("model") == len(run.models) - 1), "label", "prob_up")
    data = run.data.withColumn("is_val", F.col("roles")[len(FOLD_BOUNDARIES)] == VAL)
    return {"model": fitted, "metrics": metrics, "importance": importance, "top": top_k(importance, "importance", 10, "feature"), "data": data}


def train_final(features: DataFrame, p: BoostParams = BoostParams()) -> dict:
    """M4 + M5 + M12: 90/10 chronological fit, validation metrics, how many splits use each feature and the
    top 10 of them (R4)."""
    run = fit_together(features, p, folds=False)
    return _final(run, run.scores())


def score_latest(features: DataFrame, model: Fitted, run_id: str, dag_run_id: str,
                 created_at=None) -> DataFrame:
    """R1 + M14 + M15: newest row per symbol, prob_up, direction at 0.5,
    next-weekday prediction date; rows in the prediction-table layout."""
    latest = latest_per_symbol(features)
    scored = predicted(model_frame(latest), model.bins, model.model, ["symbol", "date"])
    out = decide(scored.withColumnRenamed("date", "feature_date"), "prob_up", "feature_date")
    ts = F.lit(created_at).cast("timestamp_ntz") if created_at else F.localtimestamp()
    return out.select("symbol", "feature_date", "prediction_date", "predicted_direction", "prob_up", "prob_down",
                      F.lit(run_id).alias("mlflow_run_id"), F.lit(dag_run_id).alias("dag_run_id"),
                      ts.alias("created_at"))


def save_model(spark: SparkSession, fitted: Fitted, base: str, run_id: str) -> str:
    """One folder per run id below a shared folder, with a table of nodes and one of bins."""
    path = f"{base.rstrip('/')}/{run_id}"
    m, b = fitted.model, fitted.bins
    nodes = [(k, i, int(t.feature[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]), t.goes_left[i].tolist(), t.depth)
             for k, t in enumerate(m.trees[: m.best]) for i in range(len(t.left))]
    spark.createDataFrame(nodes, "tree int, node int, feature int, left int, right int, value double, goes_left array<boolean>, depth int") \
        .write.mode("overwrite").parquet(f"{path}/nodes")
    rows = [(i, n, m.base, [float(x) for x in e], None) for i, (n, e) in enumerate(b.numeric.items())]
    rows += [(len(rows) + i, n, m.base, None, c) for i, (n, c) in enumerate(b.categories.items())]
    spark.createDataFrame(rows, "position int, feature string, base double, borders array<double>, categories array<string>") \
        .write.mode("overwrite").parquet(f"{path}/bins")
    return path


def load_model(spark: SparkSession, base: str, run_id: str) -> Fitted:
    path = f"{base.rstrip('/')}/{run_id}"
    bins = spark.read.parquet(f"{path}/bins").orderBy("position").collect()
    trees: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():      # rounds x leaves, a bound of the parameters
        trees.setdefault(r.tree, []).append(r)
    made = [Tree(*(np.array([r[c] for r in t], d) for c, d in (("feature", np.int32), ("left", np.int32), ("right", np.int32), ("value", float),
                                                               ("goes_left", bool))), t[0].depth) for _, t in sorted(trees.items())]
    return Fitted(Bins({r.feature: r.borders for r in bins if r.borders is not None}, {r.feature: r.categories for r in bins if r.categories is not None}),
                  Model(bins[0].base, made))


def run_row(run_id: str, dag_run_id: str, data: DataFrame, cv: DataFrame | None,
            val: DataFrame, created_at=None) -> DataFrame:
    """One model-run row (date ranges, counts, metrics) built from
    aggregates only."""
    ranges = data.groupBy().agg(
        F.min(F.when(~F.col("is_val"), F.col("date"))).alias("train_from"),
        F.max(F.when(~F.col("is_val"), F.col("date"))).alias("train_to"),
        F.min(F.when(F.col("is_val"), F.col("date"))).alias("val_from"),
        F.max(F.when(F.col("is_val"), F.col("date"))).alias("val_to"),
        F.count(F.when(~F.col("is_val"), 1)).cast("bigint").alias("n_train_rows"),
        F.count(F.when(F.col("is_val"), 1)).cast("bigint").alias("n_val_rows"))
    names = {"accuracy": "accuracy", "auc": "auc_roc", "f1": "f1", "logloss": "log_loss"}
    v = val.select(*[F.col(c).alias(f"val_{n}") for c, n in names.items()])
    row = ranges.withColumn("__k", F.lit(1)).join(v.withColumn("__k", F.lit(1)), "__k")
    if cv is not None:
        row = row.join(cv.select(*[F.col(f"cv_{c}").alias(f"cv_{n}") for c, n in names.items()]).withColumn("__k", F.lit(1)), "__k")
    ts = F.lit(created_at).cast("timestamp_ntz") if created_at else F.localtimestamp()
    return align_to_schema(row.drop("__k").select(
        F.lit(run_id).alias("mlflow_run_id"), F.concat(F.lit("run_"), truncate_text(F.lit(dag_run_id), 8)).alias("model_version"),
        F.lit(dag_run_id).alias("dag_run_id"), "*",
        F.lit(len(NUMERIC_FEATURES) + len(CATEGORICAL)).alias("n_features"), ts.alias("created_at")), MODEL_RUNS)


def new_run_id() -> str:
    return uuid.uuid4().hex


def train_and_predict(features: DataFrame, p: BoostParams = BoostParams(), dag_run_id: str = "run-1",
                      run_id: str | None = None, created_at: _dt.datetime | None = None, cv: bool = True) -> dict:
    """C4 + C5: cross-validation, the final fit and its run row, then the
    scores of the newest row of every symbol.  ``features`` is used several
    times: pass a stored table."""
    run_id = run_id or new_run_id()
    require_rows(training_stats(features, LABEL), MIN_TRAIN_ROWS)
    trained = fit_together(features, p, folds=cv)
    scores = trained.scores()
    fit = _final(trained, scores)
    fit["cv"] = _cv(scores) if cv else None
    fit["run"] = run_row(run_id, dag_run_id, fit["data"], fit["cv"]["cv"] if cv else None, fit["metrics"], created_at)
    pred = score_latest(features, fit["model"], run_id, dag_run_id, created_at)
    return {**fit, "predictions": pred, "run_id": run_id}
