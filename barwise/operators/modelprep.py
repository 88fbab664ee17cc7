"""Model data preparation and evaluation as DataFrame plans (M1-M4,
M7-M10, M15).

* folds / hold-out: the distinct-date index is bounded by the calendar, so
  it is the one table that may be broadcast; every fact row gets its fold
  membership from an equi-join on date plus an ``explode`` of the (at most
  three) folds it belongs to — no range or cross join.
* AUC is exact (mid-rank / Mann-Whitney) without a single-partition window:
  scores are aggregated to (fold, score, positives, negatives), bucketed by
  value, and the running negative count is a small per-bucket prefix plus a
  within-bucket window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise.functions import next_business_day, or_unknown, to_double
from barwise.operators.summaries import date_index

# Walk-forward folds (train start, train end, validation end)
FOLD_BOUNDARIES = [(0.00, 0.60, 0.70), (0.00, 0.70, 0.80), (0.00, 0.80, 0.90)]
HOLDOUT_FRACTION = 0.90
LOGLOSS_EPS = 2.220446049250313e-16
AUC_BUCKETS = 256


def labelled(df: DataFrame, label: str = "target_direction_1d") -> DataFrame:
    """Rows whose label is present (the training scan)."""
    return df.where(F.col(label).isNotNull())


def numeric_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """M1: numeric feature columns as double, bad values NULL."""
    return df.select(*[to_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def encode_categories(df: DataFrame, cols=("sector", "industry"), fit_on: DataFrame | None = None) -> DataFrame:
    """M2 (SQL form): alphabetical 0-based codes, NULL -> 'Unknown'.  With
    ``fit_on`` the vocabulary comes from that frame and values it lacks map
    to 'Unknown' first.  The vocabulary is the distinct values of one
    categorical column (bounded by the sector / industry lists), so its
    global ``dense_rank`` runs on a handful of rows."""
    src = fit_on if fit_on is not None else df
    out = df
    for c in cols:
        vocab = src.select(or_unknown(c).alias("__v")).distinct()
        vocab = vocab.select("__v", (F.dense_rank().over(Window.orderBy("__v")) - 1).cast("int").alias("__code"))
        out = out.withColumn("__v", or_unknown(c))
        if fit_on is not None:
            known = vocab.select(F.col("__v").alias("__known"))
            out = (out.join(known, out["__v"] == known["__known"], "left")
                      .withColumn("__v", F.when(F.col("__known").isNull(), F.lit("Unknown"))
                                  .otherwise(F.col("__v")))
                      .drop("__known"))
        out = out.join(vocab, "__v", "left").withColumn(c, F.col("__code")).drop("__v", "__code")
    return out


def _cut_idx(frac: float):
    # int(n * frac) - 1 evaluated in double precision (Q16)
    return (F.floor(F.col("n_dates").cast("double") * F.lit(float(frac))) - 1).cast("int")


def walk_forward_folds(df: DataFrame, date_col: str = "date", boundaries=FOLD_BOUNDARIES) -> DataFrame:
    """M3: rows repeated once per fold they belong to, with ``fold`` (1..3)
    and ``split`` ('train' up to the train cut, 'val' up to the val cut)."""
    idx = date_index(df, date_col)
    folds = F.array(*[F.struct(F.lit(i + 1).alias("fold"), _cut_idx(te).alias("train_end"),
                               _cut_idx(ve).alias("val_end"))
                      for i, (_, te, ve) in enumerate(boundaries)])
    idx = idx.select(date_col, "date_idx", folds.alias("__folds"))
    j = df.join(F.broadcast(idx), date_col)
    j = j.select("*", F.explode("__folds").alias("__f")).drop("__folds")
    split = (F.when(F.col("date_idx") <= F.col("__f.train_end"), F.lit("train"))
              .when(F.col("date_idx") <= F.col("__f.val_end"), F.lit("val")))
    return (j.withColumn("fold", F.col("__f.fold")).withColumn("split", split)
             .where(F.col("split").isNotNull()).drop("__f", "date_idx"))


def holdout_split(df: DataFrame, date_col: str = "date", frac: float = HOLDOUT_FRACTION) -> DataFrame:
    """M4: 'train' up to the date at index int(n*frac)-1, 'val' after it,
    with the cut date as ``cutoff_date`` on every row."""
    idx = date_index(df, date_col)
    cut = _cut_idx(frac)
    idx = idx.select(date_col, "date_idx", cut.alias("__cut"),
                     F.max(F.when(F.col("date_idx") == cut, F.col(date_col)))
                      .over(Window.partitionBy()).alias("cutoff_date"))
    j = df.join(F.broadcast(idx), date_col)
    return (j.withColumn("split", F.when(F.col("date_idx") <= F.col("__cut"), "train").otherwise("val"))
             .drop("date_idx", "__cut"))


def split_roles(df: DataFrame, cuts: list[tuple[float, float | None]], date_col: str = "date") -> DataFrame:
    """M3/M4 for models that share their rows: every row once, with ``roles``, an array of 1 (train), 2 (validation)
    or 0 per (train cut, validation cut); without a validation cut all later dates validate."""
    idx = date_index(df, date_col)
    role = lambda a, b: (F.when(F.col("date_idx") <= _cut_idx(a), 1)
                         .when(F.col("date_idx") <= _cut_idx(b) if b is not None else F.lit(True), 2).otherwise(0))
    roles = F.array(*[role(a, b) for a, b in cuts]).cast("array<int>")
    return df.join(F.broadcast(idx.select(date_col, roles.alias("roles"))), date_col)


def classification_metrics(pred: DataFrame, label: str = "y", prob: str = "prob",
                           by: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """M7-M10 per group: accuracy, ROC AUC (exact, mid-rank), F1 of the
    positive class (0 when undefined) and log loss (p clipped)."""
    if not by:
        g = pred.withColumn("__all", F.lit(1))
        return classification_metrics(g, label, prob, ["__all"], threshold).drop("__all")
    y, p = F.col(label).cast("double"), F.col(prob).cast("double")
    yhat = (p >= threshold).cast("double")
    pc = F.least(F.greatest(p, F.lit(LOGLOSS_EPS)), F.lit(1 - LOGLOSS_EPS))
    base = pred.where(F.col(label).isNotNull() & F.col(prob).isNotNull())
    simple = base.groupBy(*by).agg(
        F.avg((y == yhat).cast("double")).alias("accuracy"),
        F.sum(y * yhat).alias("__tp"), F.sum((1 - y) * yhat).alias("__fp"), F.sum(y * (1 - yhat)).alias("__fn"),
        (-F.avg(y * F.ln(pc) + (1 - y) * F.ln(1 - pc))).alias("logloss"),
    )
    f1 = F.coalesce(2 * F.col("__tp") / F.nullif(2 * F.col("__tp") + F.col("__fp") + F.col("__fn"), F.lit(0.0)),
                    F.lit(0.0))
    simple = simple.select(*by, "accuracy", f1.alias("f1"), "logloss")
    return simple.join(roc_auc(base, label, prob, by), by, "left")


def roc_auc(pred: DataFrame, label: str = "y", prob: str = "prob", by: list[str] | None = None,
            buckets: int = AUC_BUCKETS) -> DataFrame:
    """Exact AUC = sum over positives of (negatives below + half the tied
    negatives) / (P * N); NULL for a single-class group.

    Distinct scores are cut into buckets at quantiles of each group's own
    scores, so calibrated scores that cluster near 0.5 fill all buckets
    alike; a bucket's window counts on from the totals of the lower ones."""
    if not by:
        g = pred.withColumn("__all", F.lit(1))
        return roc_auc(g, label, prob, ["__all"], buckets).drop("__all")
    y = F.col(label).cast("int")
    s = (pred.groupBy(*by, F.col(prob).cast("double").alias("__s"))
             .agg(F.sum(y).alias("__pos"), F.sum(1 - y).alias("__neg")))
    cuts = [i / buckets for i in range(1, buckets)]
    edges = s.groupBy(*by).agg(F.percentile_approx("__s", cuts, 10 * buckets).alias("__edges"))
    s = s.join(edges, by).withColumn("__b", F.size(F.filter("__edges", lambda e: e < F.col("__s")))).drop("__edges")
    # per-bucket totals -> negatives in all lower buckets (<= buckets rows per group)
    bt = s.groupBy(*by, "__b").agg(F.sum("__neg").alias("__bneg"))
    wb = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumn("__neg_lower_b", F.coalesce(F.sum("__bneg").over(wb), F.lit(0))).drop("__bneg")
    s = s.join(bt, [*by, "__b"])
    wi = Window.partitionBy(*by, "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("__below", F.col("__neg_lower_b") + F.coalesce(F.sum("__neg").over(wi), F.lit(0)))
    g = s.groupBy(*by).agg(F.sum(F.col("__pos") * (F.col("__below") + 0.5 * F.col("__neg"))).alias("__u"),
                           F.sum("__pos").alias("__p"), F.sum("__neg").alias("__n"))
    return g.select(*by, (F.col("__u") / F.nullif(F.col("__p") * F.col("__n"), F.lit(0))).alias("auc"))


def decide(df: DataFrame, prob_col: str = "prob_up", date_col: str = "feature_date",
           threshold: float = 0.5) -> DataFrame:
    """Direction at ``prob_up >= 0.5``, prob_down, next weekday."""
    p = F.col(prob_col).cast("double")
    return df.select("*", (p >= threshold).cast("short").alias("predicted_direction"),
                     (1 - p).alias("prob_down"),
                     next_business_day(date_col).alias("prediction_date"))
