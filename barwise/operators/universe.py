"""Symbol-universe selection (P1-P5, P10) over the registry and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions import blank_to_null, index_key

# Fallback universe used when the registry selects nothing.
FALLBACK_EQUITIES = [
    "RELIANCE.NS", "TCS.NS", "INFY.NS", "HDFCBANK.NS",
    "ICICIBANK.NS", "WIPRO.NS", "SBIN.NS", "TATAMOTORS.NS",
    "AXISBANK.NS", "LT.NS", "HINDUNILVR.NS", "ITC.NS",
    "BAJFINANCE.NS", "MARUTI.NS", "ADANIENT.NS", "NESTLEIND.NS",
]
FALLBACK_INDICES = [
    "^NSEI", "^BSESN", "^INDIAVIX", "INR=X",
    "^CNXIT", "^NSEBANK", "^CNXPHARMA", "^CNXAUTO", "^CNXFMCG",
]


def _nonblank(c: str):
    return blank_to_null(F.col(c)).isNotNull()


def equity_universe(reg: DataFrame) -> DataFrame:
    """P1 + P3: active highlighted EQ-series equities with a ticker (no
    order: a distributed table has none until it is reported)."""
    return (reg.where((F.col("symbol_type") == "equity") & (F.col("series") == "EQ")
                      & F.col("is_active") & F.col("highlight") & _nonblank("yf_symbol"))
               .select("symbol", "yf_symbol", "sector", "industry"))


def index_universe(reg: DataFrame) -> DataFrame:
    """P2 + P3: active highlighted indices with a ticker."""
    return (reg.where((F.col("symbol_type") == "index") & F.col("is_active")
                      & F.col("highlight") & _nonblank("yf_symbol"))
               .select("symbol", "yf_symbol"))


def universe_or_fallback(universe: DataFrame, fallback: DataFrame) -> DataFrame:
    """The fallback rows only when ``universe`` is empty.  Expressed as a
    left-anti join on a constant key against one existence row, so the
    decision is made inside the plan, not on the driver."""
    exists = universe.select(F.lit(1).alias("__k")).limit(1)
    fb = (fallback.withColumn("__k", F.lit(1))
                  .join(exists, "__k", "left_anti").drop("__k"))
    return universe.unionByName(fb, allowMissingColumns=True)


def fallback_equities(spark) -> DataFrame:
    return spark.createDataFrame([(s.removesuffix(".NS"), s) for s in FALLBACK_EQUITIES],
                                 "symbol string, yf_symbol string") \
        .withColumn("sector", F.lit(None).cast("string")).withColumn("industry", F.lit(None).cast("string"))


def fallback_indices(spark) -> DataFrame:
    """P4 for indices: canonical key and ticker."""
    return (spark.createDataFrame([(s,) for s in FALLBACK_INDICES], "yf_symbol string")
            .select(index_key("yf_symbol").alias("symbol"), "yf_symbol"))


def pending(universe: DataFrame, ledger: DataFrame, data_type: str, as_of) -> DataFrame:
    """Symbols of ``universe`` not yet ingested successfully on
    ``as_of`` for ``data_type``."""
    done = (ledger.where((F.col("data_type") == data_type) & (F.col("status") == "success")
                         & (F.to_date("end_time") == F.lit(as_of).cast("date")))
                  .select(F.col("symbol").alias("yf_symbol")).distinct())
    return universe.join(done, "yf_symbol", "left_anti")


def enrichment_backlog(reg: DataFrame, n: int | None = None) -> DataFrame:
    """P10: equities of series EQ missing sector or industry.

    All of them by default: the metadata is a table join here, so there is no
    vendor call to pace.  With ``n`` it is R3, the report of the newest
    listings first (NULL listing dates last)."""
    rows = reg.where((F.col("symbol_type") == "equity") & (F.col("series") == "EQ")
                     & (F.col("sector").isNull() | F.col("industry").isNull()))
    return rows if n is None else rows.orderBy(F.col("listing_date").desc_nulls_last(), F.col("symbol")).limit(n)
