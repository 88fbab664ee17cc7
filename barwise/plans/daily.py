"""C7 — the daily run: registry -> ingestion -> features -> training ->
predictions -> document sync.  Spark schedules the work inside each stage;
nothing here loops over symbols.

All tables of a pipeline live below one folder as versioned tables
(:mod:`barwise.operators.snapshots`).  A run merges its batches into them: stored
rows are kept, symbols that the ledger has as done on this day are skipped,
audit rows are appended, and files that no batch row can match are carried
into the next version untouched.  Each stage reads the version that the stage
before it published, so a lost executor recomputes inside one stage only,
and a run that died is simply run again.  Features are brought up to date from the
rows that differ between the inputs' versions of the last build and of now.

The five ingestion branches (prices of equities and of indices, dividends,
splits, fundamentals) run at once; one that fails ends alone, is logged, and the
summary comes after all of them.

Landing inputs come from a mapping of DataFrames (the fixture adapter in
tests and benchmarks; ``ingest.read_feed`` in production).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions import truncate_text
from barwise.operators import snapshots
from barwise.operators.branches import run_branches
from barwise.operators.summaries import latest_run, status_summary
from barwise.operators.universe import (equity_universe, fallback_equities, fallback_indices, index_universe,
                                        universe_or_fallback)
from barwise.operators.upsert import align_to_schema
from barwise.plans import model as MD
from barwise.plans.incremental import changed_from, update_features
from barwise.plans.ingest import ERROR_CHARS, SPECS, ingest
from barwise.plans.jobs import (prediction_documents, run_feature_job, run_prediction_job, run_sync_job,
                                write_importance_csv)
from barwise.plans.registry import refresh_registry
from barwise.schemas import (DIVIDENDS, FUNDAMENTALS, INGESTION_DELTA, INGESTION_LOG, MODEL_RUNS, PREDICTIONS,
                             PRICE_HISTORY, SPLITS)
from barwise.session import scratch, written

#: Stored table and schema of every data type.
TABLES = {"price": ("bars", PRICE_HISTORY), "dividend": ("dividends", DIVIDENDS), "split": ("splits", SPLITS),
          "fundamental": ("fundamentals", FUNDAMENTALS)}


def _create(spark: SparkSession, path: str, schema, date_col: str | None = None) -> None:
    if not snapshots.exists(spark, path):
        month = F.date_format(date_col, "yyyy-MM") if date_col else None
        snapshots.replace(spark, path, spark.createDataFrame([], schema), part=month)


def ingest_branch(spark: SparkSession, base: str, kind: str, batch: DataFrame, universe: DataFrame, as_of: str, run_id: str, run_ts: str) -> None:
    """C2 for one data type: merge the batch, then append its ledger and audit rows."""
    name, _ = TABLES[kind]
    spec, table = SPECS[kind], f"{base}/{name}"
    with scratch(spark):
        done = ingest(snapshots.read(spark, table), batch, universe, snapshots.read(spark, f"{base}/ingestion_delta"), kind, as_of, run_id, run_ts)
        rows = written(done["batch"], "batch")
        ledger, log = written(align_to_schema(done["ledger"], INGESTION_DELTA), "ledger"), written(align_to_schema(done["log"], INGESTION_LOG), "log")
        snapshots.merge(spark, table, rows, spec["keys"], spec["update"], spec["date_col"],
                        insert_defaults={"ingested_at": F.lit(run_ts).cast("timestamp_ntz")})
        snapshots.append(spark, f"{base}/ingestion_delta", ledger)
        snapshots.append(spark, f"{base}/ingestion_log", log)


def _input_changes(spark: SparkSession, base: str) -> DataFrame | None:
    """symbol and first changed date since the inputs' versions of the last feature build; None if all is to be built."""
    if not snapshots.exists(spark, f"{base}/feature_inputs") or not snapshots.exists(spark, f"{base}/stock_features"):
        return None
    built = {r.name: r.version for r in snapshots.read(spark, f"{base}/feature_inputs").groupBy("name").agg(F.max("version").alias("version")).collect()}
    found = []
    for kind, (name, schema) in TABLES.items():
        rows = snapshots.changes(spark, f"{base}/{name}", built.get(name, -1), [f.name for f in schema if f.name != "ingested_at"])
        if rows is None:
            return None
        found.append((rows, SPECS[kind]["date_col"]))
    return changed_from(*found)


def run_daily(spark: SparkSession, landing: dict[str, DataFrame], base: str, run_id: str, as_of: str,
              run_ts: str, boost: MD.BoostParams = MD.BoostParams()) -> dict[str, DataFrame]:
    """One run over the tables below ``base``.  ``landing`` keys: registry (where there is no stored one yet), master,
    meta, bars, dividends, splits, fundamentals and, where there is one, index_bars.  Returns the stage summaries."""
    base = base.rstrip("/")
    at = lambda name: f"{base}/{name}"
    for name, schema in (("ingestion_delta", INGESTION_DELTA), ("ingestion_log", INGESTION_LOG), ("model_runs", MODEL_RUNS)):
        _create(spark, at(name), schema)
    for kind, (name, schema) in TABLES.items():
        _create(spark, at(name), schema, SPECS[kind]["date_col"])
    _create(spark, at("stock_predictions"), PREDICTIONS, "feature_date")

    # C1 registry
    with scratch(spark):
        stored = snapshots.read(spark, at("registry")) if snapshots.exists(spark, at("registry")) else landing["registry"]
        reg = refresh_registry(stored, landing["master"], landing["meta"], run_ts)
        snapshots.replace(spark, at("registry"), written(reg["registry"], "registry"))
        summary = spark.createDataFrame(reg["summary"].collect(), reg["summary"].schema)
    registry = snapshots.read(spark, at("registry"))
    universe = universe_or_fallback(equity_universe(registry), fallback_equities(spark))
    indices = universe_or_fallback(index_universe(registry), fallback_indices(spark))

    # C2 ingestion: five branches at once
    of_index = landing["index_bars"] if "index_bars" in landing else landing["bars"].limit(0)
    feeds = {"equity_prices": ("price", landing["bars"], universe), "index_prices": ("price", of_index, indices),
             "dividends": ("dividend", landing["dividends"], universe), "splits": ("split", landing["splits"], universe),
             "fundamentals": ("fundamental", landing["fundamentals"], universe)}
    done = run_branches(spark, {name: (lambda k=kind, b=batch, u=wanted: ingest_branch(spark, base, k, b, u.select("yf_symbol"), as_of, run_id, run_ts))
                                for name, (kind, batch, wanted) in feeds.items()})
    failed = [(None, feeds[n][0], "failed", 0, f"{n}: {o.error}", run_id) for n, o in done.items() if not o.ok]
    if failed:
        rows = spark.createDataFrame(failed, "symbol string, data_type string, status string, rows_affected bigint, error_msg string, dag_run_id string")
        rows = rows.withColumn("error_msg", truncate_text(F.col("error_msg"), ERROR_CHARS)).withColumn("ran_at", F.lit(run_ts).cast("timestamp_ntz"))
        snapshots.append(spark, at("ingestion_log"), align_to_schema(rows, INGESTION_LOG))
    inputs = {name: snapshots.versions(spark, at(name))[-1] for name, _ in TABLES.values()}
    tables = {name: snapshots.read(spark, at(name), number) for name, number in inputs.items()}

    # C3 features (quarantine + audit rows inside the job)
    changed = _input_changes(spark, base)
    given = (tables["bars"], tables["fundamentals"], tables["dividends"], tables["splits"], universe)
    stored = (at("stock_features"), at("ingestion_log"), run_id, run_ts)
    feats = run_feature_job(spark, *given, *stored) if changed is None else update_features(spark, *given, changed, *stored)
    snapshots.append(spark, at("feature_inputs"), spark.createDataFrame([(run_id, *x) for x in inputs.items()], "run_id string, name string, version long"))

    # C4 + C5 cross-validate, train, score the newest row per symbol, merge predictions
    with scratch(spark):
        fit = MD.train_and_predict(feats["features"], boost, dag_run_id=run_id, created_at=run_ts)
        MD.save_model(spark, fit["model"], at("models"), fit["run_id"])
        write_importance_csv(fit["importance"], at(f"importance_{fit['run_id']}"))
        snapshots.append(spark, at("model_runs"), fit["run"])
        pred = run_prediction_job(spark, align_to_schema(fit["predictions"], PREDICTIONS), at("stock_predictions"), run_id)

    # C6 serving documents
    sync = run_sync_job(spark, prediction_documents(pred["predictions"]), at("predictions_docs"))

    log = snapshots.read(spark, at("ingestion_log"))
    return {"registry": summary, "ingestion": status_summary(log, run_id),
            "features": feats["summary"], "predictions": pred["summary"], "sync": sync["stats"],
            "run": latest_run(snapshots.read(spark, at("model_runs")), run_id), "branches": done}
