"""C1 — symbol-registry refresh: equity master file + index catalog upserted
into the registry, enrichment of the backlog, summary.

The master file arrives as CSV with every field a string (A1); parsing is
column expressions only (F1-F5), so the job is one scan + one keyed merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions import (blank_to_null, index_key, parse_day_first_date, safe_double, safe_int,
                               vendor_ticker)
from barwise.operators.summaries import registry_summary
from barwise.operators.universe import enrichment_backlog
from barwise.operators.upsert import align_to_schema, upsert
from barwise.schemas import REGISTRY

# The index catalog (vendor ticker, display name, category).
BROAD_INDICES = [
    ("^NSEI", "Nifty 50", "broad"),
    ("^NSEMDCP50", "Nifty Midcap 50", "broad"),
    ("^NSMIDCP", "Nifty Midcap 100", "broad"),
    ("^CNXSC", "Nifty Smallcap 100", "broad"),
    ("^CNX100", "Nifty 100", "broad"),
    ("^CNX200", "Nifty 200", "broad"),
    ("^CNX500", "Nifty 500", "broad"),
    ("^CNXMICRO", "Nifty Microcap 250", "broad"),
    ("^BSESN", "BSE Sensex", "broad"),
    ("^INDIAVIX", "India VIX", "volatility"),
    ("INR=X", "USD/INR", "currency"),
]
SECTOR_INDICES = [
    ("^NSEBANK", "Nifty Bank", "sector"),
    ("^CNXIT", "Nifty IT", "sector"),
    ("^CNXPHARMA", "Nifty Pharma", "sector"),
    ("^CNXAUTO", "Nifty Auto", "sector"),
    ("^CNXFMCG", "Nifty FMCG", "sector"),
    ("^CNXMETAL", "Nifty Metal", "sector"),
    ("^CNXENERGY", "Nifty Energy", "sector"),
    ("^CNXREALTY", "Nifty Realty", "sector"),
    ("^CNXMEDIA", "Nifty Media", "sector"),
    ("^CNXINFRA", "Nifty Infrastructure", "sector"),
    ("^CNXPSUBANK", "Nifty PSU Bank", "sector"),
    ("^CNXFINANCE", "Nifty Financial Services", "sector"),
    ("^CNXCONSUMPTION", "Nifty India Consumption", "sector"),
    ("^CNXCOMMODITIES", "Nifty Commodities", "sector"),
    ("^CNXMNCAP", "Nifty MNC", "sector"),
    ("^CNXDIVOPPT", "Nifty Dividend Opportunities", "sector"),
    ("^CNXSERVICE", "Nifty Services Sector", "sector"),
    ("^CNXPSE", "Nifty PSE", "sector"),
]
THEMATIC_INDICES = [
    ("^CNXPVTBANK", "Nifty Private Bank", "thematic"),
    ("^CNXFINSRV25", "Nifty Financial Services 25/50", "thematic"),
    ("^CNXHEALTHCARE", "Nifty Healthcare", "thematic"),
    ("^CNXOILGAS", "Nifty Oil & Gas", "thematic"),
    ("^CNXCHEMS", "Nifty Chemicals", "thematic"),
    ("^NIFTYINDIA", "Nifty India Digital", "thematic"),
    ("^CNXSMALLCAP250", "Nifty Smallcap 250", "thematic"),
    ("^CNXMIDSMALL400", "Nifty Midsmallcap 400", "thematic"),
    ("^CNXTOTAL", "Nifty Total Market", "thematic"),
    ("^CNXALPHA", "Nifty Alpha 50", "thematic"),
    ("^CNXHIGHBETA", "Nifty High Beta 50", "thematic"),
    ("^CNXLOWVOL", "Nifty Low Volatility 50", "thematic"),
    ("^CNXQUAL30", "Nifty Quality 30", "thematic"),
    ("^CNXVALUE20", "Nifty Value 20", "thematic"),
    ("^CNXGROWTH", "Nifty Growth Sectors 15", "thematic"),
    ("^CNXMIDCAP150", "Nifty Midcap 150", "thematic"),
    ("^CNXSMALLCAP50", "Nifty Smallcap 50", "thematic"),
    ("^CNXLCAP", "Nifty Largecap 250", "thematic"),
]

EQUITY_UPDATE = ["yf_symbol", "name", "isin", "series", "listing_date", "face_value", "paid_up_value",
                 "market_lot", "is_active", "last_updated"]
INDEX_UPDATE = ["yf_symbol", "name", "index_category", "is_active", "last_updated"]
KEYS = ["symbol", "symbol_type"]


def read_equity_master(spark: SparkSession, path: str) -> DataFrame:
    """A1: the master CSV, every field a string, header names stripped."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def index_catalog(spark: SparkSession) -> DataFrame:
    """A2: the three index groups concatenated."""
    schema = "ticker string, name string, index_category string"
    parts = [spark.createDataFrame(g, schema) for g in (BROAD_INDICES, SECTOR_INDICES, THEMATIC_INDICES)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def equity_rows(master: DataFrame, as_of_ts) -> DataFrame:
    """F1-F4 on the master rows; blank symbols are skipped."""
    m = strip_headers(master)
    sym = blank_to_null("SYMBOL")
    return m.where(sym.isNotNull()).select(
        sym.alias("symbol"), F.lit("equity").alias("symbol_type"), vendor_ticker(sym).alias("yf_symbol"),
        blank_to_null("NAME OF COMPANY").alias("name"), blank_to_null("ISIN NUMBER").alias("isin"),
        blank_to_null("SERIES").alias("series"),
        parse_day_first_date("DATE OF LISTING").alias("listing_date"),
        safe_double("FACE VALUE").alias("face_value"), safe_double("PAID UP VALUE").alias("paid_up_value"),
        safe_int("MARKET LOT", zero_is_null=True).alias("market_lot"),
        F.lit(True).alias("is_active"), F.lit(as_of_ts).cast("timestamp_ntz").alias("last_updated"))


def index_rows(catalog: DataFrame, as_of_ts) -> DataFrame:
    """U8 source: canonical key from the ticker."""
    return catalog.select(index_key("ticker").alias("symbol"), F.lit("index").alias("symbol_type"),
                          F.col("ticker").alias("yf_symbol"), "name", "index_category",
                          F.lit(True).alias("is_active"), F.lit(as_of_ts).cast("timestamp_ntz").alias("last_updated"))


def enrich(reg: DataFrame, backlog: DataFrame, meta: DataFrame, as_of_ts) -> DataFrame:
    """For backlog equities with fetched metadata, COALESCE(new, old) on
    sector / industry / name; other rows untouched."""
    m = (meta.join(backlog.select("symbol"), "symbol", "left_semi")
             .select("symbol", F.lit("equity").alias("symbol_type"),
                     F.col("sector").alias("m_sector"), F.col("industry").alias("m_industry"),
                     F.col("name").alias("m_name"), F.lit(True).alias("__hit")))
    j = reg.join(m, KEYS, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return j.select(*[
        (F.when(hit, F.coalesce(F.col(f"m_{c}"), F.col(c))).otherwise(F.col(c)).alias(c)
         if c in ("sector", "industry", "name")
         else F.when(hit, F.lit(as_of_ts).cast("timestamp_ntz")).otherwise(F.col(c)).alias(c)
         if c == "last_updated" else F.col(c))
        for c in reg.columns])


def refresh_registry(target: DataFrame, master: DataFrame, meta: DataFrame, as_of_ts) -> dict[str, DataFrame]:
    """Returns the refreshed registry, the enrichment backlog and the
    summary."""
    spark = target.sparkSession
    base = align_to_schema(target, REGISTRY)
    eq = equity_rows(master, as_of_ts)
    t1 = upsert(base, eq, KEYS, EQUITY_UPDATE, insert_defaults={"highlight": F.lit(False)})
    t2 = upsert(t1, index_rows(index_catalog(spark), as_of_ts), KEYS, INDEX_UPDATE,
                insert_defaults={"highlight": F.lit(False)})
    backlog = enrichment_backlog(t2)
    t3 = enrich(t2, backlog, meta, as_of_ts)
    return {"registry": t3, "backlog": backlog, "summary": registry_summary(t3)}
