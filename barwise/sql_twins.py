"""DuckDB twins of the Spark plans, used as the correctness oracle.

They are written independently of the Spark code: rolling columns use SQL
window frames, EWMs a recursive CTE that applies the pandas recurrence
row by row, the as-of attachments DuckDB's ``ASOF JOIN``.  Both sides round
doubles the same way (6 digits, 4 for EWM-derived columns).
"""

from __future__ import annotations

from barwise.plans.features import BIGINT_COLS, DECIMALS, EWM_COLS, FEATURE_COLS, INT_COLS
from barwise.sources.fixtures import FIXTURE_SQL, fixture_cte

ALL_FIXTURES = ("price_history", "fundamentals", "dividends", "splits", "symbol_registry")


def _full(agg: str, x: str, n: int) -> str:
    return f"case when count({x}) over w{n} = {n} then {agg}({x}) over w{n} end"


def _ewm_step(y: str, w: str, x: str, a: float) -> tuple[str, str]:
    """(new y, new old-weight) of one pandas adjust=False step; ``r`` is the
    previous state row."""
    keep = f"(r.{w} * {1.0 - a!r})"
    ny = (f"case when {x} is null then r.{y} when r.{y} is null then {x} "
          f"else ({keep} * r.{y} + {a!r} * {x}) / ({keep} + {a!r}) end")
    nw = (f"case when {x} is null then (case when r.{y} is null then 1.0 else {keep} end) "
          f"else 1.0 end")
    return ny, nw


def _ewm_cte(name: str, src: str, specs: list[tuple[str, str, float]]) -> str:
    """Recursive CTE ``name``(symbol, rn, <y>...) over ``src``(symbol, rn, <x>...)."""
    init = ", ".join(f"{x} as {y}, cast(1 as double) as {y}_w" for y, x, _ in specs)
    steps = []
    for y, x, a in specs:
        ny, nw = _ewm_step(y, f"{y}_w", f"s.{x}", a)
        steps.append(f"{ny} as {y}, {nw} as {y}_w")
    return (f"{name} as (select symbol, rn, {init} from {src} where rn = 1 "
            f"union all select s.symbol, s.rn, {', '.join(steps)} "
            f"from {name} r join {src} s on s.symbol = r.symbol and s.rn = r.rn + 1)")


def features_body(min_rows: int = 60, symbol_col: str = "p_brand", bars: str | None = None) -> str:
    """WITH-prefix ending in ``full_features`` (unrounded doubles).  With
    ``symbol_col='l_suppkey'`` bars are per supplier and every symbol is used
    (no registry universe; events and registry match nothing).  ``bars`` is other SQL for the bars."""
    a12, a26, a14, a9 = 2 / 13, 2 / 27, 1 / 14, 2 / 10
    ctes = fixture_cte(*ALL_FIXTURES)
    if symbol_col != "p_brand":
        ph = FIXTURE_SQL["price_history"].replace("p_brand", f"cast({symbol_col} as varchar)")
        ctes = ctes.replace(FIXTURE_SQL["price_history"], ph)
    if bars:
        ctes = ctes.replace(FIXTURE_SQL["price_history"], bars)
    body = f""",
universe as (
  select yf_symbol, sector, industry from symbol_registry
  where symbol_type = 'equity' and series = 'EQ' and is_active and highlight
    and yf_symbol is not null and trim(yf_symbol) <> ''),
b0 as (
  select symbol, date, cast(open as double) as open, cast(high as double) as high,
         cast(low as double) as low, cast(close as double) as close, cast(volume as double) as volume,
         row_number() over (partition by symbol order by date) as rn,
         count(*) over (partition by symbol) as nb
  from price_history
  where {"symbol in (select yf_symbol from universe) and " if symbol_col == "p_brand" else ""}open is not null
    and close is not null),
b as (select * from b0 where nb >= {min_rows}),
bd as (
  select b.*, coalesce(d.amount, 0.0) as div_today
  from b left join dividends d on d.symbol = b.symbol and d.ex_date = b.date),
l1 as (
  select bd.*,
    lag(close, 1) over w as close_lag_1, lag(close, 2) over w as close_lag_2,
    lag(close, 5) over w as close_lag_5, lag(close, 21) over w as c21,
    lead(close, 1) over w as f1, lead(close, 5) over w as f5,
    {_full('avg', 'close', 5)} as sma_5, {_full('avg', 'close', 10)} as sma_10,
    {_full('avg', 'close', 20)} as sma_20, {_full('avg', 'close', 50)} as sma_50,
    {_full('avg', 'close', 200)} as sma_200, {_full('stddev_samp', 'close', 20)} as std20,
    {_full('min', 'low', 14)} as low14, {_full('max', 'high', 14)} as high14,
    {_full('avg', 'volume', 20)} as volume_sma_20,
    {_full('max', 'high', 252)} as high_52w, {_full('min', 'low', 252)} as low_52w,
    sum(div_today) over w252 as ttm_div
  from bd
  window w as (partition by symbol order by rn),
         w5 as (partition by symbol order by rn rows between 4 preceding and current row),
         w10 as (partition by symbol order by rn rows between 9 preceding and current row),
         w14 as (partition by symbol order by rn rows between 13 preceding and current row),
         w20 as (partition by symbol order by rn rows between 19 preceding and current row),
         w50 as (partition by symbol order by rn rows between 49 preceding and current row),
         w200 as (partition by symbol order by rn rows between 199 preceding and current row),
         w252 as (partition by symbol order by rn rows between 251 preceding and current row)),
l2 as (
  select l1.*,
    close / nullif(close_lag_1, 0) - 1 as daily_return,
    case when close / nullif(close_lag_1, 0) > 0 then ln(close / nullif(close_lag_1, 0)) end as log_return,
    close / nullif(close_lag_5, 0) - 1 as weekly_return,
    close / nullif(c21, 0) - 1 as monthly_return,
    case when close - close_lag_1 is null then null else greatest(close - close_lag_1, 0.0) end as gain,
    case when close_lag_1 - close is null then null else greatest(close_lag_1 - close, 0.0) end as loss,
    greatest(high - low, abs(high - close_lag_1), abs(low - close_lag_1)) as tr,
    sma_20 + 2 * std20 as bb_upper, sma_20 - 2 * std20 as bb_lower,
    nullif((sma_20 + 2 * std20) - (sma_20 - 2 * std20), 0) / nullif(sma_20, 0) as bb_width,
    (close - (sma_20 - 2 * std20)) / nullif((sma_20 + 2 * std20) - (sma_20 - 2 * std20), 0) as bb_pct,
    100 * (close - low14) / nullif(high14 - low14, 0) as stoch_k,
    volume / nullif(volume_sma_20, 0) as volume_ratio,
    (close - high_52w) / nullif(high_52w, 0) as pct_from_52w_high,
    (close - low_52w) / nullif(low_52w, 0) as pct_from_52w_low,
    (f1 - close) / nullif(close, 0) as target_return_1d,
    (f5 - close) / nullif(close, 0) as target_return_5d,
    case when symbol in (select symbol from dividends) then ttm_div / nullif(close, 0) end as dividend_yield_ttm
  from l1),
l3 as (
  select l2.*,
    lag(daily_return, 1) over w as return_lag_1, lag(daily_return, 2) over w as return_lag_2,
    lag(daily_return, 5) over w as return_lag_5,
    {_full('stddev_samp', 'daily_return', 5)} as rolling_std_5,
    {_full('stddev_samp', 'daily_return', 20)} as rolling_std_20,
    {_full('avg', 'stoch_k', 3)} as stoch_d
  from l2
  window w as (partition by symbol order by rn),
         w3 as (partition by symbol order by rn rows between 2 preceding and current row),
         w5 as (partition by symbol order by rn rows between 4 preceding and current row),
         w20 as (partition by symbol order by rn rows between 19 preceding and current row)),
{_ewm_cte('e1', 'l2', [('ema_12', 'close', a12), ('ema_26', 'close', a26), ('avg_gain', 'gain', a14),
                        ('avg_loss', 'loss', a14), ('atr_14', 'tr', a14)])},
m as (select symbol, rn, ema_12 - ema_26 as macd from e1),
{_ewm_cte('e2', 'm', [('macd_signal', 'macd', a9)])},
fa as (
  select l3.symbol, l3.date, f.pe_ratio, f.pb_ratio, f.eps, f.revenue, f.net_income,
         f.debt_to_equity, f.roe, f.market_cap
  from l3 asof left join fundamentals f on l3.symbol = f.symbol and l3.date >= f.as_of_date),
dv as (
  select l3.symbol, l3.date, date_diff('day', d.ex_date, l3.date) as days_since_dividend
  from l3 asof left join dividends d on l3.symbol = d.symbol and l3.date >= d.ex_date),
sp as (
  select l3.symbol, l3.date, date_diff('day', s.split_date, l3.date) as days_since_split
  from l3 asof left join splits s on l3.symbol = s.symbol and l3.date >= s.split_date),
full_features as (
  select l3.*, e1.ema_12, e1.ema_26, e1.ema_12 - e1.ema_26 as macd, e2.macd_signal,
         (e1.ema_12 - e1.ema_26) - e2.macd_signal as macd_hist,
         100 - 100 / (1 + e1.avg_gain / nullif(e1.avg_loss, 0)) as rsi_14, e1.atr_14,
         fa.pe_ratio, fa.pb_ratio, fa.eps, fa.revenue, fa.net_income, fa.debt_to_equity, fa.roe, fa.market_cap,
         dv.days_since_dividend, sp.days_since_split, u.sector, u.industry,
         cast(case when target_return_1d is null then null when target_return_1d > 0 then 1 else 0 end as smallint)
           as target_direction_1d,
         cast(case when target_return_5d is null then null when target_return_5d > 0 then 1 else 0 end as smallint)
           as target_direction_5d
  from l3
  join e1 on e1.symbol = l3.symbol and e1.rn = l3.rn
  join e2 on e2.symbol = l3.symbol and e2.rn = l3.rn
  join fa on fa.symbol = l3.symbol and fa.date = l3.date
  join dv on dv.symbol = l3.symbol and dv.date = l3.date
  join sp on sp.symbol = l3.symbol and sp.date = l3.date
  left join universe u on u.yf_symbol = l3.symbol)
"""
    return ctes.replace("with ", "with recursive ", 1) + body


def _rounded_select(cols: list[str]) -> str:
    sel = []
    for c in cols:
        if c in DECIMALS:
            sel.append(f"round(cast({c} as double), {4 if c in EWM_COLS else 6}) as {c}")
        elif c in BIGINT_COLS:
            sel.append(f"cast({c} as bigint) as {c}")
        elif c in INT_COLS:
            sel.append(f"cast({c} as integer) as {c}")
        else:
            sel.append(c)
    return ", ".join(sel)


def features_cte(min_rows: int = 60) -> str:
    """WITH-prefix ending in ``ff``: the rounded feature table."""
    return (features_body(min_rows) + f",\nff as (select {_rounded_select(FEATURE_COLS)} from full_features)\n")


def features_sql(cols: list[str] | None = None, min_rows: int = 60, symbol_col: str = "p_brand", bars: str | None = None) -> str:
    """The whole feature build over the fixture tables, rounded."""
    return (features_body(min_rows, symbol_col, bars)
            + f"select {_rounded_select(cols or FEATURE_COLS)} from full_features")
