"""Test-data adapter: derive the logical input tables (bars, dividends,
splits, fundamentals, symbol registry) from the driver's TPC-H-style tables.

Every derivation is a DataFrame plan over ``lineitem`` and ``part`` so its
cost grows with the tables.  The SQL twins in ``FIXTURE_SQL`` compute the
same tables in DuckDB for the correctness oracle.

Scale notes:
* bars aggregate ticks per (symbol, date).  Open/close are picked with
  ``min_by``/``max_by`` over a total row ordering instead of a
  ``row_number`` window, so a hot (symbol, date) group is pre-aggregated
  map-side and never materialised in one task.
* the ``part`` join is left to Catalyst/AQE: it broadcasts only when the
  measured side is under ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ticks(spark: SparkSession, sf_dir: str, symbol_col: str = "p_brand") -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    if symbol_col == "p_brand":
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        j = li.join(part, li.l_partkey == part.p_partkey)
    else:
        j = li
    return j.select(
        F.col(symbol_col).alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).alias("px"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        # total ordering of ticks inside a day (ties on every field carry the same price)
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_quantity", "l_discount", "l_tax").alias("ord"),
    )


def price_history(spark: SparkSession, sf_dir: str, symbol_col: str = "p_brand") -> DataFrame:
    """Daily OHLCV bars: symbol = brand (or supplier key), date = ship date."""
    t = _ticks(spark, sf_dir, symbol_col)
    # a key that is a number is grouped and sorted as one, and becomes text afterwards
    return t.groupBy("symbol", "date").agg(
        F.min_by("px", "ord").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "ord").alias("close"),
        F.max_by("px", "ord").alias("adj_close"),
        F.sum("qty").cast("bigint").alias("volume"),
    ).withColumn("symbol", F.col("symbol").cast("string"))


def _li_part(spark, sf_dir, li_cols, part_cols=("p_partkey", "p_brand")):
    li = read_table(spark, sf_dir, "lineitem").select(*li_cols)
    part = read_table(spark, sf_dir, "part").select(*part_cols)
    return li.join(part, li.l_partkey == part.p_partkey)


def dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse dividend events; odd orders are shifted one day so some
    ex-dates fall on non-trading dates; Brand#3 has none."""
    j = _li_part(spark, sf_dir, ["l_orderkey", "l_partkey", "l_linenumber", "l_tax",
                                 "l_discount", "l_returnflag", "l_shipdate"])
    j = j.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
                & (F.col("l_discount") >= 0.09) & (F.col("p_brand") != "Brand#3"))
    return (j.select(F.col("p_brand").alias("symbol"),
                     F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 2).cast("int")).alias("ex_date"),
                     (F.col("l_tax") * 10).alias("amt"))
            .groupBy("symbol", "ex_date").agg(F.round(F.sum("amt"), 4).alias("amount")))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split events; Brand#5 has none."""
    j = _li_part(spark, sf_dir, ["l_partkey", "l_linenumber", "l_quantity", "l_tax",
                                 "l_discount", "l_shipdate"])
    j = j.where((F.col("l_quantity") >= 48) & (F.col("l_tax") >= 0.07)
                & (F.col("l_discount") <= 0.01) & (F.col("p_brand") != "Brand#5"))
    return (j.select(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("split_date"),
                     "l_linenumber")
            .groupBy("symbol", "split_date")
            .agg((F.max("l_linenumber") + 1).cast("double").alias("ratio")))


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly snapshots; some have NULL pe_ratio; Brand#7 has none."""
    j = _li_part(spark, sf_dir, ["l_partkey", "l_linenumber", "l_quantity", "l_tax",
                                 "l_discount", "l_shipdate"],
                 ("p_partkey", "p_brand", "p_retailprice"))
    j = j.where(F.month("l_shipdate").isin(1, 4, 7, 10) & (F.col("p_brand") != "Brand#7"))
    q = F.col("l_quantity").cast("bigint")
    g = (j.select(F.col("p_brand").alias("symbol"),
                  F.trunc(F.to_date("l_shipdate"), "month").alias("as_of_date"),
                  "p_retailprice", "l_discount", "l_tax", "l_quantity", "l_linenumber", q.alias("q"))
         .groupBy("symbol", "as_of_date")
         .agg(F.count(F.lit(1)).alias("n"),
              F.avg("p_retailprice").alias("rp"), F.avg("l_discount").alias("disc"),
              F.sum("q").alias("revenue"),
              F.sum(F.col("q") * F.col("l_linenumber")).alias("net_income"),
              F.avg("l_tax").alias("tax"), F.avg("l_quantity").alias("qty")))
    return g.select(
        "symbol", "as_of_date",
        F.when(F.col("n") % 4 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("n").cast("double") / 8).alias("pe_ratio"),
        F.round(F.col("rp") / 100, 4).alias("pb_ratio"),
        F.round(F.col("disc") * 100, 4).alias("eps"),
        F.col("revenue").cast("bigint").alias("revenue"),
        F.col("net_income").cast("bigint").alias("net_income"),
        F.round(F.col("tax") * 100, 4).alias("debt_to_equity"),
        F.round(F.col("qty"), 4).alias("roe"),
        (F.col("n") * 1000).cast("bigint").alias("market_cap"),
    )


def symbol_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One equity row per brand; Brand#9 has no industry."""
    part = read_table(spark, sf_dir, "part").select("p_brand", "p_type", "p_name")
    g = part.groupBy("p_brand").agg(F.min("p_type").alias("sector"), F.min("p_name").alias("mn"))
    return g.select(
        F.col("p_brand").alias("symbol"), F.lit("equity").alias("symbol_type"),
        F.col("p_brand").alias("yf_symbol"), F.lit("EQ").alias("series"), "sector",
        F.when(F.col("p_brand") == "Brand#9", F.lit(None).cast("string"))
         .otherwise(F.col("mn")).alias("industry"),
        F.lit(True).alias("is_active"), F.lit(True).alias("highlight"),
    )


# DuckDB twins of the derivations above (same statements as FIXTURES.md §2).
FIXTURE_SQL = {
    "price_history": """
  select symbol, date, max(case when rn = 1 then px end) as open, max(px) as high, min(px) as low,
         max(case when rn = n then px end) as close, max(case when rn = n then px end) as adj_close,
         cast(sum(qty) as bigint) as volume
  from (
    select p_brand as symbol, cast(l_shipdate as date) as date,
           floor(l_extendedprice * 100 / l_quantity) / 100 as px, cast(l_quantity as bigint) as qty,
           row_number() over (partition by p_brand, cast(l_shipdate as date)
             order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) as rn,
           count(*) over (partition by p_brand, cast(l_shipdate as date)) as n
    from lineitem join part on l_partkey = p_partkey) ticks
  group by symbol, date""",
    "dividends": """
  select p_brand as symbol, cast(l_shipdate as date) + cast(l_orderkey % 2 as int) as ex_date,
         round(sum(l_tax * 10), 4) as amount
  from lineitem join part on l_partkey = p_partkey
  where l_returnflag = 'R' and l_linenumber = 1 and l_discount >= 0.09 and p_brand <> 'Brand#3'
  group by 1, 2""",
    "splits": """
  select p_brand as symbol, cast(l_shipdate as date) as split_date,
         cast(max(l_linenumber) + 1 as double) as ratio
  from lineitem join part on l_partkey = p_partkey
  where l_quantity >= 48 and l_tax >= 0.07 and l_discount <= 0.01 and p_brand <> 'Brand#5'
  group by 1, 2""",
    "fundamentals": """
  select p_brand as symbol, cast(date_trunc('month', l_shipdate) as date) as as_of_date,
         case when count(*) % 4 = 0 then null else cast(count(*) as double) / 8 end as pe_ratio,
         round(avg(p_retailprice) / 100, 4) as pb_ratio, round(avg(l_discount) * 100, 4) as eps,
         cast(sum(cast(l_quantity as bigint)) as bigint) as revenue,
         cast(sum(cast(l_quantity as bigint) * l_linenumber) as bigint) as net_income,
         round(avg(l_tax) * 100, 4) as debt_to_equity, round(avg(l_quantity), 4) as roe,
         cast(count(*) * 1000 as bigint) as market_cap
  from lineitem join part on l_partkey = p_partkey
  where month(l_shipdate) in (1, 4, 7, 10) and p_brand <> 'Brand#7'
  group by 1, 2""",
    "symbol_registry": """
  select p_brand as symbol, 'equity' as symbol_type, p_brand as yf_symbol, 'EQ' as series,
         min(p_type) as sector,
         case when p_brand = 'Brand#9' then null else min(p_name) end as industry,
         true as is_active, true as highlight
  from part group by p_brand""",
}


def fixture_cte(*names: str) -> str:
    """``WITH`` prefix defining the named fixture tables for an oracle query."""
    return "with " + ",\n".join(f"{n} as ({FIXTURE_SQL[n]})" for n in names) + "\n"


# ---- registry / ingestion inputs ---------------------------------------------------
# Equity master "file" rows: all strings, some header names padded with blanks,
# blank symbols (negative balance), an unparsable face value and listing date,
# empty market lots.  Built from ``supplier`` so it scales with the tables.
RUN_TS = "2025-01-05 00:00:00"
AS_OF = "2025-01-05"
SNAPSHOT_CUT = "1999-01-01"     # stored bars end before this date
BATCH_FROM = "1998-10-01"       # the re-fetched batch starts here (overlap)


def equity_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    lst = F.date_add(F.lit("1990-01-01").cast("date"), F.col("s_suppkey").cast("int"))
    return s.select(
        F.when(F.col("s_acctbal") < 0, F.lit("  "))
         .otherwise(F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias(" SYMBOL"),
        F.col("s_name").alias("NAME OF COMPANY "),
        F.when(F.col("s_nationkey") < 5, F.lit("BE")).otherwise(F.lit("EQ")).alias("SERIES"),
        F.when(F.col("s_nationkey") == 7, F.lit("not a date"))
         .otherwise(F.upper(F.date_format(lst, "dd-MMM-yyyy"))).alias(" DATE OF LISTING"),
        F.round(F.col("s_acctbal"), 0).cast("string").alias("PAID UP VALUE"),
        F.when(F.col("s_nationkey") == 3, F.lit("")).otherwise(F.col("s_nationkey").cast("string")).alias("MARKET LOT"),
        F.concat(F.lit("INE"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("ISIN NUMBER"),
        F.when(F.col("s_nationkey") == 11, F.lit("abc"))
         .otherwise((F.col("s_nationkey") + 1).cast("string")).alias("FACE VALUE"),
    )


def vendor_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched sector / industry / long name per supplier symbol (nation 2 has no sector)."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                    F.when(F.col("s_nationkey") == 2, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("sector"),
                    F.col("n_name").alias("industry"),
                    F.concat(F.col("s_name"), F.lit(" Ltd")).alias("name"))


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar table as stored before this run: dates before SNAPSHOT_CUT."""
    return (price_history(spark, sf_dir).where(F.col("date") < F.lit(SNAPSHOT_CUT).cast("date"))
            .withColumn("ingested_at", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))


def bar_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's fetched bars: from BATCH_FROM on, adj_close revised."""
    b = price_history(spark, sf_dir).where(F.col("date") >= F.lit(BATCH_FROM).cast("date"))
    return b.withColumn("adj_close", F.round(F.col("close") * 0.98, 4))


def split_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that records today's successful 'split' ingestion of every
    symbol that has splits."""
    sp = splits(spark, sf_dir)
    c = sp.groupBy("symbol").agg(F.min("split_date").alias("data_from"), F.max("split_date").alias("data_to"),
                                 F.count(F.lit(1)).cast("bigint").alias("record_count"))
    ts = F.lit(RUN_TS).cast("timestamp_ntz")
    return c.select("symbol", F.lit("split").alias("data_type"), "data_from", "data_to", ts.alias("start_time"),
                    ts.alias("end_time"), F.lit("success").alias("status"), "record_count",
                    F.lit(None).cast("string").alias("error_msg"), F.lit("run-0").alias("dag_run_id"),
                    ts.alias("created_at"))


FIXTURE_SQL.update({
    "equity_master": """
  select case when s_acctbal < 0 then '  ' else 'S' || cast(s_suppkey as varchar) end as " SYMBOL",
         s_name as "NAME OF COMPANY ",
         case when s_nationkey < 5 then 'BE' else 'EQ' end as "SERIES",
         case when s_nationkey = 7 then 'not a date'
              else upper(strftime(date '1990-01-01' + cast(s_suppkey as integer), '%d-%b-%Y')) end as " DATE OF LISTING",
         cast(round(s_acctbal, 0) as varchar) as "PAID UP VALUE",
         case when s_nationkey = 3 then '' else cast(s_nationkey as varchar) end as "MARKET LOT",
         'INE' || lpad(cast(s_suppkey as varchar), 6, '0') as "ISIN NUMBER",
         case when s_nationkey = 11 then 'abc' else cast(s_nationkey + 1 as varchar) end as "FACE VALUE"
  from supplier""",
    "vendor_metadata": """
  select 'S' || cast(s_suppkey as varchar) as symbol,
         case when s_nationkey = 2 then null else r_name end as sector, n_name as industry,
         s_name || ' Ltd' as name
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
})
FIXTURE_SQL["stored_bars"] = f"""
  select *, timestamp '2000-01-01 00:00:00' as ingested_at from ({FIXTURE_SQL['price_history']}) ph
  where date < date '{SNAPSHOT_CUT}'"""
FIXTURE_SQL["bar_batch"] = f"""
  select symbol, date, open, high, low, close, round(close * 0.98, 4) as adj_close, volume
  from ({FIXTURE_SQL['price_history']}) ph where date >= date '{BATCH_FROM}'"""
FIXTURE_SQL["split_ledger"] = f"""
  select symbol, 'split' as data_type, min(split_date) as data_from, max(split_date) as data_to,
         timestamp '{RUN_TS}' as start_time, timestamp '{RUN_TS}' as end_time, 'success' as status,
         cast(count(*) as bigint) as record_count, cast(null as varchar) as error_msg, 'run-0' as dag_run_id,
         timestamp '{RUN_TS}' as created_at
  from ({FIXTURE_SQL['splits']}) sp group by symbol"""


EVENT_TABLES = {"dividend": ("dividends", "ex_date"), "split": ("splits", "split_date"),
                "fundamental": ("fundamentals", "as_of_date")}


def stored_events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """An event table as stored before this run: events before SNAPSHOT_CUT."""
    name, date_col = EVENT_TABLES[kind]
    t = {"dividends": dividends, "splits": splits, "fundamentals": fundamentals}[name](spark, sf_dir)
    return (t.where(F.col(date_col) < F.lit(SNAPSHOT_CUT).cast("date"))
             .withColumn("ingested_at", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))


# ---- rows that reach the rarer branches (their SQL is in sql_twins_ops) ------------------------
def messy_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars without open (the 13th) or close (the 14th), infinite highs and lows (the 27th), and 59 bars of Brand#11."""
    day, infinite = F.dayofmonth("date"), F.lit(float("inf"))
    number = F.row_number().over(Window.partitionBy("symbol").orderBy("date"))
    b = price_history(spark, sf_dir).withColumn("k", number).where((F.col("symbol") != "Brand#11") | (F.col("k") <= 59))
    return b.select("symbol", "date", F.when(day != 13, F.col("open")).alias("open"),
                    F.when(day == 27, infinite).otherwise(F.col("high")).alias("high"),
                    F.when(day == 27, -infinite).otherwise(F.col("low")).alias("low"),
                    F.when(day != 14, F.col("close")).alias("close"), "volume")


def spiked_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of which Brand#21's returns overflow their column."""
    spike = (F.col("symbol") == "Brand#21") & (F.dayofmonth("date") == 15)
    return price_history(spark, sf_dir).withColumn("close", F.when(spike, F.col("close") * 1e6).otherwise(F.col("close")))


def marked_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored registry with indices, blank tickers, marks, and known sectors that new metadata lacks."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    symbol = F.concat(F.lit("S"), key.cast("string"))
    return read_table(spark, sf_dir, "supplier").select(
        symbol.alias("symbol"), F.when(nation % 4 == 0, "index").otherwise("equity").alias("symbol_type"),
        F.when(key % 7 == 0, "  ").when(key % 7 != 1, F.concat(symbol, F.lit(".NS"))).alias("yf_symbol"),
        F.when(nation == 5, "BE").otherwise("EQ").alias("series"), F.when(key % 2 == 0, "Old sector").alias("sector"),
        F.when(key % 3 == 0, "Old industry").alias("industry"), F.when(key % 5 == 0, "Old name").alias("name"),
        F.when(key % 11 != 0, F.date_add(F.lit("1990-01-01").cast("date"), (key % 40).cast("int"))).alias("listing_date"),
        (nation != 1).alias("is_active"), (nation % 3 != 0).alias("highlight"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("last_updated"))
