"""C3 — the feature build: 47 model features and 4 labels for every
(symbol, date) of every symbol in ONE plan.

Physical shape (see ``explain``):
  1. bars, fundamentals, dividends and splits of the universe are tagged and
     unioned, exchanged ONCE by ``symbol`` and sorted by (date, tag);
     a single Window node yields the as-of fundamentals row, the dividend
     on the bar date, the newest dividend / split dates, the bar index and
     the per-symbol bar count (J3-J6, P6).
  2. event rows are dropped, the bar index ``rn`` and EWM block ``blk``
     define the one ordering (symbol, blk, rn) that every later Window
     node shares: one more sort, no more exchanges.
  3. rolling / lag / lead columns (W1-W43) in two Window nodes, and the block
     EWMs (§ ewm).  What an EWM does not read is packed into one struct that
     the EWM's nodes copy as one value, and ratios come after them; generated
     methods stay under the 8,000 bytes that the JVM compiles.
Rows per window partition are bounded by the trading days of one symbol,
because (symbol, date) is the key of the bar table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise.functions import finite_or_null, round_double, sdiv, to_decimal
from barwise.operators.ewm import EwmSpec, com_alpha, ewm, span_alpha
from barwise.operators.windows import (EWM_BLOCK, SYMBOL_SERIES, SqlWindow, sql_div, with_sql)

_SW = SqlWindow(SYMBOL_SERIES)

MIN_HISTORY = 60

FUNDAMENTAL_COLS = ["pe_ratio", "pb_ratio", "eps", "revenue", "net_income",
                    "debt_to_equity", "roe", "market_cap"]

# Output columns of the feature table, in table order.
FEATURE_COLS = [
    "symbol", "date",
    "daily_return", "log_return", "weekly_return", "monthly_return",
    "sma_5", "sma_10", "sma_20", "sma_50", "sma_200",
    "ema_12", "ema_26",
    "macd", "macd_signal", "macd_hist",
    "rsi_14",
    "bb_upper", "bb_lower", "bb_width", "bb_pct",
    "atr_14", "stoch_k", "stoch_d",
    "volume_sma_20", "volume_ratio",
    "rolling_std_5", "rolling_std_20",
    "high_52w", "low_52w", "pct_from_52w_high", "pct_from_52w_low",
    "close_lag_1", "close_lag_2", "close_lag_5",
    "return_lag_1", "return_lag_2", "return_lag_5",
    "pe_ratio", "pb_ratio", "eps", "revenue", "net_income",
    "debt_to_equity", "roe", "market_cap",
    "dividend_yield_ttm", "days_since_dividend",
    "days_since_split",
    "sector", "industry",
    "target_return_1d", "target_return_5d",
    "target_direction_1d", "target_direction_5d",
]

# Storage precision (p, s) of the numeric feature columns.
DECIMALS = {
    "daily_return": (12, 8), "log_return": (12, 8), "weekly_return": (12, 8), "monthly_return": (12, 8),
    "sma_5": (14, 4), "sma_10": (14, 4), "sma_20": (14, 4), "sma_50": (14, 4), "sma_200": (14, 4),
    "ema_12": (14, 4), "ema_26": (14, 4),
    "macd": (14, 6), "macd_signal": (14, 6), "macd_hist": (14, 6),
    "rsi_14": (8, 4),
    "bb_upper": (14, 4), "bb_lower": (14, 4), "bb_width": (12, 6), "bb_pct": (12, 6),
    "atr_14": (14, 4), "stoch_k": (8, 4), "stoch_d": (8, 4),
    "volume_sma_20": (22, 2), "volume_ratio": (12, 4),
    "rolling_std_5": (12, 8), "rolling_std_20": (12, 8),
    "high_52w": (14, 4), "low_52w": (14, 4), "pct_from_52w_high": (12, 6), "pct_from_52w_low": (12, 6),
    "close_lag_1": (14, 4), "close_lag_2": (14, 4), "close_lag_5": (14, 4),
    "return_lag_1": (12, 8), "return_lag_2": (12, 8), "return_lag_5": (12, 8),
    "pe_ratio": (12, 4), "pb_ratio": (12, 4), "eps": (12, 4), "debt_to_equity": (12, 4), "roe": (12, 4),
    "dividend_yield_ttm": (12, 8),
    "target_return_1d": (12, 8), "target_return_5d": (12, 8),
}
BIGINT_COLS = ["revenue", "net_income", "market_cap"]
INT_COLS = ["days_since_dividend", "days_since_split"]
SHORT_COLS = ["target_direction_1d", "target_direction_5d"]
EWM_COLS = ["ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14"]
NUMERIC_FEATURES = [c for c in FEATURE_COLS[2:]
                    if c not in ("sector", "industry") and not c.startswith("target_")]


def event_timeline(bars: DataFrame, fundamentals: DataFrame | None = None,
                   dividends: DataFrame | None = None, splits: DataFrame | None = None,
                   min_rows: int = MIN_HISTORY, block: int = EWM_BLOCK) -> DataFrame:
    """Steps 1-2 of the plan: bars with their event context, rn and blk.

    Output: symbol, date, open, high, low, close, volume, fund (struct of the
    as-of snapshot), div_today, last_div_date, last_split_date, has_div,
    rn, blk.  Only symbols with at least ``min_rows`` bars are kept (P6).
    """
    spark = bars.sparkSession
    fund_t = "struct<" + ",".join(
        f"{c}:{'bigint' if c in BIGINT_COLS else 'double'}" for c in FUNDAMENTAL_COLS) + ">"
    b = bars.where(F.col("close").isNotNull()).select("symbol", "date",
                    *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                    F.col("volume").cast("double").alias("volume"), F.lit(1).alias("tag"))
    parts = [b]
    if fundamentals is not None:
        parts.append(fundamentals.select(
            "symbol", F.col("as_of_date").alias("date"), F.lit(0).alias("tag"),
            F.struct(*[F.col(c).cast("bigint" if c in BIGINT_COLS else "double").alias(c)
                       for c in FUNDAMENTAL_COLS]).alias("fund")))
    if dividends is not None:
        parts.append(dividends.select("symbol", F.col("ex_date").alias("date"), F.lit(0).alias("tag"),
                                      F.col("amount").cast("double").alias("div_amount")))
    if splits is not None:
        parts.append(splits.select("symbol", F.col("split_date").alias("date"), F.lit(0).alias("tag"),
                                   F.lit(True).alias("is_split")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    for c, t in (("fund", fund_t), ("div_amount", "double"), ("is_split", "boolean")):
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast(t))

    wt = Window.partitionBy("symbol").orderBy("date", "tag").rowsBetween(Window.unboundedPreceding, 0)
    # the same ordering as wt, so both frames share one Window node
    wsym = Window.partitionBy("symbol").orderBy("date", "tag").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_bar = (F.col("tag") == 1).cast("int")
    is_div = F.col("div_amount").isNotNull()
    last_div = F.max(F.when(is_div, F.col("date"))).over(wt)
    u = u.select(
        "symbol", "date", "tag", "open", "high", "low", "close", "volume",
        F.last("fund", ignorenulls=True).over(wt).alias("fund"),
        last_div.alias("last_div_date"),
        F.last(F.when(is_div, F.col("div_amount")), ignorenulls=True).over(wt).alias("last_div_amount"),
        F.max(F.when(F.col("is_split"), F.col("date"))).over(wt).alias("last_split_date"),
        F.max(is_div.cast("int")).over(wsym).alias("has_div"),
        F.sum(is_bar).over(wsym).alias("n_bars"),
        F.sum(is_bar).over(wt).alias("rn"),
    )
    u = u.where((F.col("tag") == 1) & (F.col("n_bars") >= min_rows))
    return u.select(
        "symbol", "date", "open", "high", "low", "close", "volume", "fund",
        F.when(F.col("last_div_date") == F.col("date"), F.col("last_div_amount"))
         .otherwise(F.lit(0.0)).alias("div_today"),
        "last_div_date", "last_split_date", (F.col("has_div") == 1).alias("has_div"),
        F.col("rn").cast("int").alias("rn"),
        ((F.col("rn") - 1) / block).cast("int").alias("blk"),
    )


def technical_features(tl: DataFrame, legacy_labels: bool = False) -> DataFrame:
    """W1-W43 over an event timeline (output of :func:`event_timeline`)."""
    wall = _SW.whole
    # what no window reads travels as one value
    tl = tl.select("symbol", "rn", "blk", "high", "low", "close", "volume", "div_today",
                   F.struct("date", "fund", "last_div_date", "last_split_date", "has_div").alias("_ev"))
    # level 0: running sums / counts and block extremes (one Window node).
    # Running-sum means are used only where the exact mean has at most 5
    # decimals (sma_50, sma_200: cents / n), so their ~1e-10 error can never
    # move a 6-digit rounding; 20-row means stay exact frames (bb bands add
    # full-precision stddev to them).
    l0 = with_sql(tl, {"_f_close": f"min(CASE WHEN close IS NOT NULL THEN rn END) {wall}",
                       "close_lag_1": _SW.lag("close", 1),
                       **_SW.running("close", "c"), **_SW.running("div_today", "d"), **_SW.running("high", "h"),
                       **_SW.running("low", "l"),
                       "_n14": f"count(high + low) {_SW.frame(14)}",
                       **_SW.extreme_parts("high", "h", 252, "max"), **_SW.extreme_parts("low", "l", 252, "min")})
    # the 14-row extremes of the stochastic are the blocks of the 252-row ones
    k14 = "CASE WHEN _n14 = 14 THEN {} END"
    l0 = with_sql(l0, {
        "daily_return": f"{sql_div('close', 'close_lag_1')} - 1",
        "stoch_k": k14.format(sql_div("100 * (close - __xb_l)", "nullif(__xb_h - __xb_l, 0D)")),
        "_gain": "CASE WHEN (close - close_lag_1) IS NOT NULL THEN greatest(close - close_lag_1, 0D) END",
        "_loss": "CASE WHEN (close_lag_1 - close) IS NOT NULL THEN greatest(close_lag_1 - close, 0D) END",
        "_tr": "greatest(high - low, abs(high - close_lag_1), abs(low - close_lag_1))",
    })
    # level 1: lags, leads, short frames and the O(1) rolling columns (one Window node)
    l1 = with_sql(l0, {
        **{f"close_lag_{k}": _SW.lag("close", k) for k in range(2, 10)},
        "_c21": _SW.lag("close", 21), "_f1": _SW.lag("close", 1, "lead"), "_f5": _SW.lag("close", 5, "lead"),
        "_k1": _SW.lag("stoch_k", 1), "_k2": _SW.lag("stoch_k", 2),
        "sma_20": _SW.full("avg", "close", 20, "__rc_c"), "_m50": _SW.fast_mean("c", 50), "_m200": _SW.fast_mean("c", 200),
        "_std20": _SW.full("stddev_samp", "close", 20, "__rc_c"),
        "volume_sma_20": _SW.full("avg", "volume", 20),
        "rolling_std_5": _SW.full("stddev_samp", "daily_return", 5),
        "rolling_std_20": _SW.full("stddev_samp", "daily_return", 20),
        "high_52w": _SW.fast_extreme("h", 252, "greatest"), "low_52w": _SW.fast_extreme("l", 252, "least"),
        "_ttm_div": _SW.delta("__rs_d", 252),
        "_f_gain": f"min(CASE WHEN _gain IS NOT NULL THEN rn END) {wall}",
        "_prev_tr": f"last(CASE WHEN _tr IS NOT NULL THEN rn END, true) {_SW.before}",
    })

    # EWM pass 1: prices, Wilder averages, ATR;  pass 2: MACD signal
    # close has no NULLs (bars without close are dropped), so close, gain,
    # loss and macd are dense after their first value; high / low may be
    # NULL, so the true range takes the general gap-aware path.
    series = ["symbol", "rn", "blk", "close", "_f_close", "_gain", "_loss", "_f_gain", "_tr", "_prev_tr"]
    done = ["_ev", "volume", "daily_return", *[f"close_lag_{k}" for k in range(1, 10)], "_c21", "_f1", "_f5",
            "sma_20", "_m50", "_m200", "_std20", "volume_sma_20", "rolling_std_5", "rolling_std_20",
            "high_52w", "low_52w", "_ttm_div", "stoch_k", "_k1", "_k2"]
    l2 = l1.select(*series, F.struct(*done).alias("_done"))
    l3 = ewm(l2, [EwmSpec("ema_12", "close", span_alpha(12), "_f_close"),
                  EwmSpec("ema_26", "close", span_alpha(26), "_f_close"),
                  EwmSpec("_avg_gain", "_gain", com_alpha(13), "_f_gain"),
                  EwmSpec("_avg_loss", "_loss", com_alpha(13), "_f_gain"),
                  EwmSpec("atr_14", "_tr", com_alpha(13), prev="_prev_tr")])

    def lagged(k):
        return f"_done.close_lag_{k}"

    ratios = {
        "weekly_return": f"{sql_div('close', lagged(5))} - 1",
        # daily_return of an earlier row, from the closes it is made of
        **{f"return_lag_{k}": f"{sql_div(lagged(k), lagged(k + 1))} - 1" for k in (1, 2, 5)},
        # short means add oldest first, as a frame does; a missing row makes them NULL
        **{f"sma_{n}": f"({' + '.join(lagged(k) for k in range(n - 1, 0, -1))} + close) / {n}D" for n in (5, 10)},
        "stoch_d": "(_done._k2 + _done._k1 + _done.stoch_k) / 3D",
        "target_return_1d": sql_div("_done._f1 - close", "close"), "target_return_5d": sql_div("_done._f5 - close", "close"),
    }
    l3 = l3.select("symbol", "rn", "blk", "close", "_f_close", "_done", "ema_12", "ema_26", "_avg_gain", "_avg_loss", "atr_14",
                   (F.col("ema_12") - F.col("ema_26")).alias("macd"),
                   F.struct(*[F.expr(e).alias(c) for c, e in ratios.items()]).alias("_ratios"))
    l4 = ewm(l3, [EwmSpec("macd_signal", "macd", span_alpha(9), "_f_close")])
    l4 = l4.select("symbol", "close", "ema_12", "ema_26", "_avg_gain", "_avg_loss", "atr_14", "macd", "macd_signal",
                   "_done.*", "_ratios.*").select("*", "_ev.*", *[round_double(f"_m{n}", 8).alias(f"sma_{n}") for n in (50, 200)])

    bb_upper, bb_lower = "(sma_20 + 2 * _std20)", "(sma_20 - 2 * _std20)"
    bb_range = f"nullif({bb_upper} - {bb_lower}, 0D)"

    def label(t):
        lab = f"CAST({t} > 0 AS SMALLINT)"
        return f"coalesce({lab}, CAST(0 AS SMALLINT))" if legacy_labels else lab

    l4 = with_sql(l4, {
        "log_return": f"ln({sql_div('close', 'close_lag_1')})",
        "monthly_return": f"{sql_div('close', '_c21')} - 1",
        "bb_upper": bb_upper, "bb_lower": bb_lower,
        "bb_width": sql_div(bb_range, "sma_20"),
        "bb_pct": sql_div(f"close - {bb_lower}", bb_range),
        "volume_ratio": sql_div("volume", "volume_sma_20"),
        "pct_from_52w_high": sql_div("close - high_52w", "high_52w"),
        "pct_from_52w_low": sql_div("close - low_52w", "low_52w"),
        "target_direction_1d": label("target_return_1d"), "target_direction_5d": label("target_return_5d"),
        "dividend_yield_ttm": f"CASE WHEN has_div THEN {sql_div('_ttm_div', 'close')} END",
    })
    rs = sdiv("_avg_gain", "_avg_loss")
    return l4.select(
        "*",
        (F.col("macd") - F.col("macd_signal")).alias("macd_hist"),
        (100 - 100 / (1 + rs)).alias("rsi_14"),
    )


def build_features(bars: DataFrame, fundamentals: DataFrame | None = None,
                   dividends: DataFrame | None = None, splits: DataFrame | None = None,
                   universe: DataFrame | None = None, min_rows: int = MIN_HISTORY,
                   legacy_labels: bool = False) -> DataFrame:
    """C3 as doubles: FEATURE_COLS (no rounding) for the universe.

    ``universe`` has (yf_symbol, sector, industry); without it all symbols
    are used with NULL sector/industry.  Bars without open or close are
    dropped (P7); NaN and infinity count as missing.
    """
    # one NaN would stay in every running sum after it: not-a-number is missing
    bars = bars.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in ("open", "high", "low", "close", "volume")})
    bars = bars.where(F.col("open").isNotNull() & F.col("close").isNotNull())
    if universe is not None:
        u = universe.select(F.col("yf_symbol").alias("symbol"), "sector", "industry")
        keep = u.select("symbol")
        bars = bars.join(keep, "symbol", "left_semi")
        fundamentals = fundamentals.join(keep, "symbol", "left_semi") if fundamentals is not None else None
        dividends = dividends.join(keep, "symbol", "left_semi") if dividends is not None else None
        splits = splits.join(keep, "symbol", "left_semi") if splits is not None else None
    tl = event_timeline(bars, fundamentals, dividends, splits, min_rows)
    f = technical_features(tl, legacy_labels)
    f = f.select("*", *[F.col(f"fund.{c}").alias(c) for c in FUNDAMENTAL_COLS],
                 F.datediff("date", "last_div_date").alias("days_since_dividend"),
                 F.datediff("date", "last_split_date").alias("days_since_split"))
    if universe is not None:
        f = f.join(u, "symbol", "left")
    else:
        f = f.withColumn("sector", F.lit(None).cast("string")).withColumn("industry", F.lit(None).cast("string"))
    return f.select(*FEATURE_COLS)


def round_features(df: DataFrame, digits: int = 6, ewm_digits: int = 4) -> DataFrame:
    """Comparison form: doubles rounded (EWM-derived columns coarser)."""
    coarse = [c for c in df.columns if c in EWM_COLS]
    out = []
    for c in df.columns:
        if c in DECIMALS and c not in coarse:
            out.append(round_double(F.col(c).cast("double"), digits).alias(c))
        elif c in BIGINT_COLS:
            out.append(F.col(c).cast("bigint").alias(c))
        elif c in INT_COLS:
            out.append(F.col(c).cast("int").alias(c))
        elif c not in coarse:
            out.append(F.col(c))
    if not coarse:
        return df.select(*out)
    # Spark generates a projection with a higher-order function as many small methods; with a rounding of its own for
    # every column it would be one method, too long for the JVM to compile
    rounded = F.transform(F.array(*[F.col(c).cast("double") for c in coarse]), lambda x: round_double(x, ewm_digits))
    return df.select(*out, rounded.alias("_coarse")).select(
        *[F.col("_coarse")[coarse.index(c)].alias(c) if c in coarse else F.col(c) for c in df.columns])


def to_feature_schema(df: DataFrame, computed_at: _dt.datetime | None = None) -> DataFrame:
    """P11 + F20: project to the table schema, round-on-store into
    DECIMAL(p, s).  A symbol with any value that overflows its decimal is
    quarantined (Q14): ``_status`` = 'failed' on all of its rows."""
    ts = F.lit(computed_at).cast("timestamp_ntz") if computed_at else F.localtimestamp()
    cast_cols, overflow = [], []
    for c in FEATURE_COLS:
        if c in DECIMALS:
            p, s = DECIMALS[c]
            cast_cols.append(to_decimal(c, p, s).alias(c))
            overflow.append(F.col(c).isNotNull() & to_decimal(c, p, s).isNull())
        elif c in BIGINT_COLS:
            cast_cols.append(F.col(c).cast("bigint").alias(c))
        elif c in INT_COLS:
            cast_cols.append(F.col(c).cast("int").alias(c))
        elif c in SHORT_COLS:
            cast_cols.append(F.col(c).cast("short").alias(c))
        else:
            cast_cols.append(F.col(c))
    bad = F.max(F.greatest(*[o.cast("int") for o in overflow])).over(Window.partitionBy("symbol"))
    return df.select(*cast_cols, ts.alias("computed_at"),
                     F.when(bad == 1, F.lit("failed")).otherwise(F.lit("success")).alias("_status"))
