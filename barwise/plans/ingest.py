"""C2 — ingestion: landing feeds -> typed batches -> keyed upserts, with the
run ledger and the audit log derived from the same batch.

Per data type the Spark job is: universe ``left_anti`` today's successful
ledger rows (P5) -> feed ``left_semi`` pending -> clean (P7, F6) -> upsert
(U1-U4) and, from one aggregate of the batch (G6), the ledger (U12) and
audit rows (U11).  No per-symbol loop, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions import local_date, to_bigint, to_double, truncate_text, volume_or_zero
from barwise.operators.summaries import coverage
from barwise.operators.universe import pending
from barwise.operators.upsert import dedupe_batch, upsert

# Vendor column names of the daily-bar feed.
BAR_FEED_COLUMNS = {"Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close",
                    "Adj Close": "adj_close", "Volume": "volume"}
# Vendor keys of the fundamentals snapshot.
FUNDAMENTAL_KEYS = {"trailingPE": "pe_ratio", "priceToBook": "pb_ratio", "trailingEps": "eps",
                    "totalRevenue": "revenue", "netIncomeToCommon": "net_income",
                    "debtToEquity": "debt_to_equity", "returnOnEquity": "roe", "marketCap": "market_cap"}

#: Characters of an error text that the ledger keeps.
ERROR_CHARS = 500

SPECS = {
    "price": dict(keys=["symbol", "date"], date_col="date",
                  update=["open", "high", "low", "close", "adj_close", "volume"]),
    "dividend": dict(keys=["symbol", "ex_date"], date_col="ex_date", update=["amount"]),
    "split": dict(keys=["symbol", "split_date"], date_col="split_date", update=["ratio"]),
    "fundamental": dict(keys=["symbol", "as_of_date"], date_col="as_of_date",
                        update=list(FUNDAMENTAL_KEYS.values())),
}


def normalize_bars(raw: DataFrame, tz: str | None = None) -> DataFrame:
    """A3 + F6 + F7 + P7: vendor columns renamed, date made local, volume
    NULL or NaN -> 0, unreadable and NaN prices NULL, rows without open or
    close dropped.  ``raw`` carries a
    ``symbol`` column (one landing file per symbol is read with its name)."""
    df = raw.withColumnsRenamed({k: v for k, v in BAR_FEED_COLUMNS.items() if k in raw.columns})
    return (df.select("symbol", local_date(F.col("date").try_cast("timestamp"), tz).alias("date") if dict(df.dtypes)["date"] != "date"
                      else F.col("date"),
                      *[to_double(c).alias(c) for c in ("open", "high", "low", "close", "adj_close")],
                      volume_or_zero("volume").alias("volume"))
              .dropna(subset=["date", "open", "close"]))


def read_feed(spark: SparkSession, path: str, kind: str, fmt: str = "parquet", as_of=None, tz: str | None = None) -> DataFrame:
    """Landing files of one feed as a typed batch.

    ``fmt`` is parquet, csv (with a header; every field is read as text and
    parsed by the normaliser) or json (one object a line).  ``kind`` is a key
    of SPECS; fundamentals are stamped with ``as_of``."""
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        raw = raw.toDF(*[c.strip() for c in raw.columns])
    else:
        raw = spark.read.format(fmt).load(path)
    if kind == "price":
        return normalize_bars(raw, tz)
    return normalize_fundamentals(raw, as_of) if kind == "fundamental" else normalize_events(raw, kind, tz)


def normalize_events(raw: DataFrame, kind: str, tz: str | None = None) -> DataFrame:
    """A4/A5: (symbol, date, value) -> dividends / splits batch; rows whose
    date or value cannot be read are dropped."""
    date, value = ("ex_date", "amount") if kind == "dividend" else ("split_date", "ratio")
    day = F.col(date) if dict(raw.dtypes)[date] == "date" else local_date(F.col(date).try_cast("timestamp"), tz)
    return raw.select("symbol", day.alias(date), to_double(value).alias(value)).dropna(subset=[date, value])


def normalize_fundamentals(raw: DataFrame, as_of) -> DataFrame:
    """Vendor keys -> columns, stamped with the run date; a missing key or
    an unreadable field ("N/A") is NULL."""
    def field(k, v):
        c = F.col(k) if k in raw.columns else F.lit(None).cast("string")
        return (to_bigint(c) if v in ("revenue", "net_income", "market_cap") else to_double(c)).alias(v)
    return raw.select("symbol", F.lit(as_of).cast("date").alias("as_of_date"), *[field(k, v) for k, v in FUNDAMENTAL_KEYS.items()])


def ingest(target: DataFrame, batch: DataFrame, universe: DataFrame, ledger: DataFrame,
           data_type: str, as_of, run_id: str, run_ts) -> dict[str, DataFrame]:
    """One data type of C2.  Returns the batch of the pending symbols, the merged
    table, the new ledger rows and the new audit-log rows.

    Symbols pending without any row in the batch: prices are 'failed'
    (empty response); events are 'success' with 0 records and no log row.
    """
    spec = SPECS[data_type]
    todo = pending(universe, ledger, data_type, as_of).select(F.col("yf_symbol").alias("symbol"))
    b = dedupe_batch(batch.join(todo, "symbol", "left_semi"), spec["keys"])
    merged = upsert(target, b, spec["keys"], spec["update"],
                    insert_defaults={"ingested_at": F.lit(run_ts).cast("timestamp_ntz")})
    cov = coverage(b, spec["date_col"])
    led = todo.join(cov, "symbol", "left")
    empty = F.col("record_count").isNull()
    failed = empty if data_type == "price" else F.lit(False)
    ts = F.lit(run_ts).cast("timestamp_ntz")
    ledger_rows = led.select(
        "symbol", F.lit(data_type).alias("data_type"), "data_from", "data_to",
        ts.alias("start_time"), ts.alias("end_time"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.coalesce("record_count", F.lit(0)).cast("bigint").alias("record_count"),
        truncate_text(F.when(failed, F.lit("Empty response")), ERROR_CHARS).alias("error_msg"),
        F.lit(run_id).alias("dag_run_id"), ts.alias("created_at"))
    log_rows = (led.where(~empty | failed)
                   .select("symbol", F.lit(data_type).alias("data_type"),
                           F.when(failed, "failed").otherwise("success").alias("status"),
                           F.coalesce("record_count", F.lit(0)).cast("bigint").alias("rows_affected"),
                           F.when(failed, F.lit("Empty response")).alias("error_msg"),
                           F.lit(run_id).alias("dag_run_id"), ts.alias("ran_at")))
    return {"batch": b, "table": merged, "ledger": ledger_rows, "log": log_rows}
