"""Incremental bar ingestion with Structured Streaming.

Landing files (one Parquet file per symbol and fetch, vendor columns plus
``symbol``) are picked up by a file-source stream; each micro-batch is
normalised (A3, F6, P7) and merged into the bar table with the keyed upsert
(U1).  The stream's checkpoint records which files were consumed, so a
rerun after a lost executor or a killed driver neither skips nor repeats a
file; ``trigger(availableNow=True)`` turns the daily run into a bounded job.

The table is versioned (:mod:`barwise.operators.snapshots`): a micro-batch
rewrites only the files it touches and publishes the next version, so readers
always meet a whole one.  The merge is idempotent: a replayed batch gives the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.operators import snapshots
from barwise.plans.ingest import SPECS, normalize_bars

LANDING_SCHEMA = ("symbol string, Date timestamp_ntz, Open double, High double, Low double, Close double, "
                  "`Adj Close` double, Volume double")


def merge_bars(spark: SparkSession, table_dir: str, run_ts):
    spec = SPECS["price"]

    def _merge(batch: DataFrame, batch_id: int) -> None:
        snapshots.merge(spark, table_dir, batch, spec["keys"], spec["update"], "date",
                        insert_defaults={"ingested_at": F.lit(run_ts).cast("timestamp_ntz")})
    return _merge


def start_bar_ingestion(spark: SparkSession, landing_dir: str, base: DataFrame, table_dir: str,
                        checkpoint_dir: str, run_ts, tz: str | None = None, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``.  A table that does
    not exist yet begins with the rows of ``base``."""
    if not snapshots.exists(spark, table_dir):
        snapshots.replace(spark, table_dir, base, SPECS["price"]["keys"], F.date_format("date", "yyyy-MM"))
    raw = spark.readStream.schema(LANDING_SCHEMA).parquet(landing_dir)
    batch = normalize_bars(raw, tz)
    w = (batch.writeStream.foreachBatch(merge_bars(spark, table_dir, run_ts))
              .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_table(spark: SparkSession, table_dir: str, base: DataFrame) -> DataFrame:
    """The table as it is now, with the columns of ``base``; ``base`` before the first run."""
    return snapshots.read(spark, table_dir).select(base.columns) if snapshots.exists(spark, table_dir) else base
