"""DuckDB twins for registry, ingestion, bookkeeping and model-prep queries."""

from __future__ import annotations

from barwise.operators.universe import FALLBACK_EQUITIES
from barwise.operators.modelprep import FOLD_BOUNDARIES, HOLDOUT_FRACTION, LOGLOSS_EPS
from barwise.plans.registry import (BROAD_INDICES, EQUITY_UPDATE, INDEX_UPDATE, SECTOR_INDICES,
                                    THEMATIC_INDICES)
from barwise.schemas import REGISTRY
from barwise.sources.fixtures import AS_OF, FIXTURE_SQL, RUN_TS
from barwise.sql_twins import features_body, features_cte, features_sql

_DUCK_T = {"string": "varchar", "double": "double", "int": "integer", "bigint": "bigint", "date": "date",
           "timestamp_ntz": "timestamp",
           "timestamp": "timestamp", "boolean": "boolean", "smallint": "smallint"}


def _dt(field) -> str:
    return _DUCK_T[field.dataType.simpleString()]


def upsert_sql(t: str, s: str, keys: list[str], target_cols: list[str], source_cols: list[str],
               update: list[str], defaults: dict[str, str] | None = None, types: dict[str, str] | None = None) -> str:
    """SELECT of ``t`` merged with ``s`` (INSERT ... ON CONFLICT DO UPDATE)."""
    defaults = defaults or {}
    types = types or {}
    k0 = keys[0]
    out = []
    for c in target_cols + [c for c in source_cols if c not in target_cols]:
        tv = f"t.{c}" if c in target_cols else "null"
        sv = f"s.{c}" if c in source_cols else defaults.get(c, "null")
        if c in keys:
            v = f"coalesce(t.{c}, s.{c})"
        elif c in update:
            v = f"case when s.{k0} is not null then {sv} else {tv} end"
        else:
            v = f"case when t.{k0} is not null then {tv} else {sv} end"
        if c in types:
            v = f"cast({v} as {types[c]})"
        out.append(f"{v} as {c}")
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    return f"select {', '.join(out)} from {t} t full outer join {s} s on {on}"


def _parse_date(x: str) -> str:
    fmts = ["%d-%b-%Y", "%d-%m-%Y", "%d/%m/%Y", "%Y-%m-%d"]
    return "cast(coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in fmts) + ") as date)"


def _nb(c: str) -> str:
    return f"nullif(trim({c}), '')"


EQUITY_ROWS_SQL = f"""
  select {_nb('" SYMBOL"')} as symbol, 'equity' as symbol_type, {_nb('" SYMBOL"')} || '.NS' as yf_symbol,
         {_nb('"NAME OF COMPANY "')} as name, {_nb('"ISIN NUMBER"')} as isin, {_nb('"SERIES"')} as series,
         {_parse_date(_nb('" DATE OF LISTING"'))} as listing_date,
         try_cast({_nb('"FACE VALUE"')} as double) as face_value,
         try_cast({_nb('"PAID UP VALUE"')} as double) as paid_up_value,
         nullif(try_cast(try_cast({_nb('"MARKET LOT"')} as double) as integer), 0) as market_lot,
         true as is_active, timestamp '{RUN_TS}' as last_updated
  from equity_master where {_nb('" SYMBOL"')} is not null"""


def _values(rows) -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in rows)


INDEX_ROWS_SQL = f"""
  select ltrim(ticker, '^') as symbol, 'index' as symbol_type, ticker as yf_symbol, name, index_category,
         true as is_active, timestamp '{RUN_TS}' as last_updated
  from (values {_values(BROAD_INDICES + SECTOR_INDICES + THEMATIC_INDICES)}) v(ticker, name, index_category)"""
# '=' -> '_' in the canonical key
INDEX_ROWS_SQL = INDEX_ROWS_SQL.replace("ltrim(ticker, '^')", "replace(ltrim(ticker, '^'), '=', '_')")

REG_COLS = [f.name for f in REGISTRY.fields]
REG_TYPES = {f.name: _dt(f) for f in REGISTRY.fields}
EQ_COLS = ["symbol", "symbol_type", "yf_symbol", "name", "isin", "series", "listing_date", "face_value",
           "paid_up_value", "market_lot", "is_active", "last_updated"]
IDX_COLS = ["symbol", "symbol_type", "yf_symbol", "name", "index_category", "is_active", "last_updated"]


def registry_ctes() -> str:
    base_sel = ", ".join(
        (f"cast({c} as {REG_TYPES[c]}) as {c}" if c in ("symbol", "yf_symbol", "symbol_type", "sector",
                                                          "industry", "series", "is_active", "highlight")
         else f"cast(null as {REG_TYPES[c]}) as {c}") for c in REG_COLS)
    return f"""with symbol_registry as ({FIXTURE_SQL['symbol_registry']}),
equity_master as ({FIXTURE_SQL['equity_master']}),
vendor_metadata as ({FIXTURE_SQL['vendor_metadata']}),
base as (select {base_sel} from symbol_registry),
eq as ({EQUITY_ROWS_SQL}),
ix as ({INDEX_ROWS_SQL}),
t1 as ({upsert_sql('base', 'eq', ['symbol', 'symbol_type'], REG_COLS, EQ_COLS, EQUITY_UPDATE,
                   {'highlight': 'false'}, REG_TYPES)}),
t2 as ({upsert_sql('t1', 'ix', ['symbol', 'symbol_type'], REG_COLS, IDX_COLS, INDEX_UPDATE,
                   {'highlight': 'false'}, REG_TYPES)}),
backlog as (
  select * from t2 where symbol_type = 'equity' and series = 'EQ' and (sector is null or industry is null)),
hits as (select m.* from vendor_metadata m where m.symbol in (select symbol from backlog)),
t3 as (
  select {', '.join(
      (f"case when h.symbol is not null then coalesce(h.{c}, t2.{c}) else t2.{c} end as {c}"
       if c in ('sector', 'industry', 'name') else
       f"case when h.symbol is not null then timestamp '{RUN_TS}' else t2.{c} end as {c}"
       if c == 'last_updated' else f"t2.{c}") for c in REG_COLS)}
  from t2 left join hits h on h.symbol = t2.symbol and t2.symbol_type = 'equity')
"""


REGISTRY_SQL = {
    "registry_equity_rows": f"with equity_master as ({FIXTURE_SQL['equity_master']}) {EQUITY_ROWS_SQL}",
    "registry_refresh": registry_ctes() + "select * from t3",
    "registry_backlog": registry_ctes() + "select * from backlog",
    "registry_summary": registry_ctes() + """
select symbol_type, index_category, cast(count(*) as bigint) as total, cast(count(sector) as bigint) as with_sector
from t3 where is_active group by symbol_type, index_category""",
    "index_universe": registry_ctes() + """,
uni as (select symbol, yf_symbol from t3 where symbol_type = 'index' and is_active and highlight
          and yf_symbol is not null and trim(yf_symbol) <> ''),
fb as (select replace(ltrim(t, '^'), '=', '_') as symbol, t as yf_symbol
       from (values ('^NSEI'), ('^BSESN'), ('^INDIAVIX'), ('INR=X'), ('^CNXIT'), ('^NSEBANK'), ('^CNXPHARMA'),
                    ('^CNXAUTO'), ('^CNXFMCG')) v(t))
select * from uni union all select * from fb where not exists (select 1 from uni)""",
    "equity_universe": registry_ctes() + f""",
uni as (select symbol, yf_symbol, sector, industry from t3
        where symbol_type = 'equity' and series = 'EQ' and is_active and highlight
          and yf_symbol is not null and trim(yf_symbol) <> ''),
fb as (select replace(t, '.NS', '') as symbol, t as yf_symbol, cast(null as varchar) as sector,
              cast(null as varchar) as industry
       from (values {", ".join(f"('{t}')" for t in FALLBACK_EQUITIES)}) v(t))
select * from uni union all select * from fb where not exists (select 1 from uni)""",
}

PRICE_COLS = ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume", "ingested_at"]
BATCH_COLS = ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume"]


def ingest_ctes() -> str:
    return f"""with symbol_registry as ({FIXTURE_SQL['symbol_registry']}),
stored as ({FIXTURE_SQL['stored_bars']}),
batch0 as ({FIXTURE_SQL['bar_batch']}),
dividends as ({FIXTURE_SQL['dividends']}),
ledger as ({FIXTURE_SQL['split_ledger']}),
universe as (select symbol, yf_symbol from symbol_registry
  where symbol_type = 'equity' and series = 'EQ' and is_active and highlight and trim(yf_symbol) <> ''),
todo_price as (select yf_symbol as symbol from universe where yf_symbol not in (
  select symbol from ledger where data_type = 'price' and status = 'success' and cast(end_time as date) = date '{AS_OF}')),
todo_div as (select yf_symbol as symbol from universe where yf_symbol not in (
  select symbol from ledger where data_type = 'dividend' and status = 'success' and cast(end_time as date) = date '{AS_OF}')),
todo_split as (select yf_symbol as symbol from universe where yf_symbol not in (
  select symbol from ledger where data_type = 'split' and status = 'success' and cast(end_time as date) = date '{AS_OF}')),
batch as (select * from batch0 where symbol in (select symbol from todo_price)),
merged as ({upsert_sql('stored', 'batch', ['symbol', 'date'], PRICE_COLS, BATCH_COLS,
                       ['open', 'high', 'low', 'close', 'adj_close', 'volume'],
                       {'ingested_at': f"timestamp '{RUN_TS}'"})}),
cov_price as (select symbol, min(date) as data_from, max(date) as data_to, cast(count(*) as bigint) as record_count
  from batch group by symbol),
div_batch as (select * from dividends where symbol in (select symbol from todo_div)),
cov_div as (select symbol, min(ex_date) as data_from, max(ex_date) as data_to, cast(count(*) as bigint) as record_count
  from div_batch group by symbol),
led_price as (
  select p.symbol, 'price' as data_type, c.data_from, c.data_to, timestamp '{RUN_TS}' as start_time,
         timestamp '{RUN_TS}' as end_time,
         case when c.record_count is null then 'failed' else 'success' end as status,
         cast(coalesce(c.record_count, 0) as bigint) as record_count,
         case when c.record_count is null then 'Empty response' end as error_msg,
         'run-1' as dag_run_id, timestamp '{RUN_TS}' as created_at
  from todo_price p left join cov_price c on c.symbol = p.symbol),
led_div as (
  select p.symbol, 'dividend' as data_type, c.data_from, c.data_to, timestamp '{RUN_TS}' as start_time,
         timestamp '{RUN_TS}' as end_time, 'success' as status,
         cast(coalesce(c.record_count, 0) as bigint) as record_count, cast(null as varchar) as error_msg,
         'run-1' as dag_run_id, timestamp '{RUN_TS}' as created_at
  from todo_div p left join cov_div c on c.symbol = p.symbol),
log_rows as (
  select symbol, data_type, status, record_count as rows_affected, error_msg, dag_run_id,
         start_time as ran_at from led_price
  union all
  select symbol, data_type, status, record_count, error_msg, dag_run_id, start_time from led_div
  where record_count > 0)
"""


INGEST_SQL = {
    "ingest_prices": ingest_ctes() + "select * from merged",
    "ingest_ledger": ingest_ctes() + "select * from led_price union all select * from led_div",
    "ingestion_summary": ingest_ctes() + """
select data_type, status, cast(count(*) as bigint) as n, cast(coalesce(sum(rows_affected), 0) as bigint) as rows
from log_rows where dag_run_id = 'run-1' group by data_type, status""",
    "pending_splits": ingest_ctes() + "select symbol as yf_symbol from todo_split",
}


# ---- model preparation, predictions, documents ----------------------------------------
def _model_ctes() -> str:
    folds = ", ".join(f"({i + 1}, {te!r}, {ve!r})" for i, (_, te, ve) in enumerate(FOLD_BOUNDARIES))
    return features_cte() + f""",
lab as (select * from ff where target_direction_1d is not null),
di as (select date, row_number() over (order by date) - 1 as date_idx, count(*) over () as n_dates
       from (select distinct date from lab) x),
fb as (select * from (values {folds}) v(fold, te, ve)),
cuts as (select di.date, di.date_idx, fb.fold,
                cast(floor(n_dates * cast(fb.te as double)) - 1 as integer) as train_end,
                cast(floor(n_dates * cast(fb.ve as double)) - 1 as integer) as val_end
         from di, fb),
fj as (select lab.*, c.fold,
              case when c.date_idx <= c.train_end then 'train' when c.date_idx <= c.val_end then 'val' end as split
       from lab join cuts c on c.date = lab.date),
v as (select fold, cast(target_direction_1d as double) as y, coalesce(stoch_k / 100, 0.5) as p
      from fj where split = 'val'),
mm as (
  select fold,
         avg(case when y = (case when p >= 0.5 then 1.0 else 0.0 end) then 1.0 else 0.0 end) as accuracy,
         sum(y * (case when p >= 0.5 then 1.0 else 0.0 end)) as tp,
         sum((1 - y) * (case when p >= 0.5 then 1.0 else 0.0 end)) as fp,
         sum(y * (1 - (case when p >= 0.5 then 1.0 else 0.0 end))) as fn,
         -avg(y * ln(least(greatest(p, {LOGLOSS_EPS!r}), {1 - LOGLOSS_EPS!r}))
              + (1 - y) * ln(1 - least(greatest(p, {LOGLOSS_EPS!r}), {1 - LOGLOSS_EPS!r}))) as logloss
  from v group by fold),
rk as (select fold, y, rank() over (partition by fold order by p) as r,
              count(*) over (partition by fold, p) as ties from v),
auc as (select fold, (sum(case when y = 1 then r + (ties - 1) / 2.0 end) - sum(y) * (sum(y) + 1) / 2.0)
                     / nullif(sum(y) * sum(1 - y), 0) as auc
        from rk group by fold),
metrics as (
  select mm.fold, mm.accuracy, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1, mm.logloss, auc.auc
  from mm left join auc on auc.fold = mm.fold),
latest as (select * from ff qualify row_number() over (partition by symbol order by date desc) = 1),
pred as (
  select symbol, date as feature_date,
         date + cast(case dayofweek(date) when 5 then 3 when 6 then 2 else 1 end as integer) as prediction_date,
         cast(case when coalesce(stoch_k / 100, 0.5) >= 0.5 then 1 else 0 end as smallint) as predicted_direction,
         coalesce(stoch_k / 100, 0.5) as prob_up, 1 - coalesce(stoch_k / 100, 0.5) as prob_down,
         'baseline' as mlflow_run_id, 'run-1' as dag_run_id, timestamp '{RUN_TS}' as created_at
  from latest),
prev as (
  select symbol, date as feature_date,
         date + cast(case dayofweek(date) when 5 then 3 when 6 then 2 else 1 end as integer) as prediction_date,
         cast(case when coalesce(stoch_d / 100, 0.5) >= 0.5 then 1 else 0 end as smallint) as predicted_direction,
         coalesce(stoch_d / 100, 0.5) as prob_up, 1 - coalesce(stoch_d / 100, 0.5) as prob_down
  from latest where symbol in (select symbol from dividends)),
docs as (
  select symbol, cast(feature_date as varchar) as feature_date, cast(prediction_date as varchar) as prediction_date,
         cast(predicted_direction as integer) as predicted_direction, round(prob_up, 6) as prob_up,
         round(prob_down, 6) as prob_down, mlflow_run_id, dag_run_id, cast(created_at as varchar) as created_at
  from pred)
"""


def _r6(cols):
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


MODEL_SQL = {
    "training_stats": _model_ctes() + """
select cast(count(*) as bigint) as n_rows, cast(count(distinct symbol) as bigint) as n_symbols,
       min(date) as min_date, max(date) as max_date,
       round(sum(cast(target_direction_1d as double)) / nullif(count(*), 0), 6) as up_share
from lab""",
    "walk_forward_folds": _model_ctes() + """
select fold, split, cast(count(*) as bigint) as n_rows, min(date) as min_date, max(date) as max_date,
       cast(sum(target_direction_1d) as bigint) as n_up
from fj where split is not null group by fold, split""",
    "holdout_split": _model_ctes() + f""",
hc as (select max(case when date_idx = cast(floor(n_dates * cast({HOLDOUT_FRACTION!r} as double)) - 1 as integer)
                       then date end) as cutoff_date,
              max(cast(floor(n_dates * cast({HOLDOUT_FRACTION!r} as double)) - 1 as integer)) as cut from di),
hs as (select lab.date, case when di.date_idx <= hc.cut then 'train' else 'val' end as split, hc.cutoff_date
       from lab join di on di.date = lab.date, hc)
select split, cutoff_date, cast(count(*) as bigint) as n_rows, min(date) as min_date, max(date) as max_date
from hs group by split, cutoff_date""",
    "encode_categories": _model_ctes() + """,
vs as (select v, cast(dense_rank() over (order by v) - 1 as integer) as code
       from (select distinct coalesce(sector, 'Unknown') as v from ff) x),
vi as (select v, cast(dense_rank() over (order by v) - 1 as integer) as code
       from (select distinct coalesce(industry, 'Unknown') as v from ff) x)
select ff.symbol, ff.date, vs.code as sector, vi.code as industry
from ff join vs on vs.v = coalesce(ff.sector, 'Unknown') join vi on vi.v = coalesce(ff.industry, 'Unknown')""",
    "latest_features": _model_ctes() + """
select symbol, date, close_lag_1, sma_20, rsi_14, stoch_k, target_direction_1d from latest""",
    "fold_metrics": _model_ctes() + f"select fold, {_r6(['accuracy', 'auc', 'f1', 'logloss'])} from metrics",
    "cv_average": _model_ctes() + """
select round(avg(accuracy), 6) as cv_accuracy, round(avg(auc), 6) as cv_auc, round(avg(f1), 6) as cv_f1,
       round(avg(logloss), 6) as cv_logloss from metrics""",
    "predictions": _model_ctes() + """
select symbol, feature_date, prediction_date, predicted_direction, round(prob_up, 6) as prob_up,
       round(prob_down, 6) as prob_down, mlflow_run_id, dag_run_id, created_at from pred""",
    "prediction_summary": _model_ctes() + """
select cast(count(*) as bigint) as total, cast(count(case when predicted_direction = 1 then 1 end) as bigint) as up,
       cast(count(case when predicted_direction = 0 then 1 end) as bigint) as down from pred""",
    "prediction_documents": _model_ctes() + "select * from docs",
    "document_upsert_stats": _model_ctes() + """
select cast(count(case when p.symbol is null then 1 end) as bigint) as inserted,
       cast(count(case when p.symbol is not null and (
            c.prediction_date is distinct from p.prediction_date
         or c.predicted_direction is distinct from p.predicted_direction
         or c.prob_up is distinct from p.prob_up or c.prob_down is distinct from p.prob_down) then 1 end) as bigint)
         as modified,
       cast(count(*) as bigint) as total
from pred c left join prev p on p.symbol = c.symbol and p.feature_date = c.feature_date""",
    "symbol_history": _model_ctes() + """
select symbol, date, close_lag_1, sma_20, rsi_14, daily_return from ff where symbol = 'Brand#13'""",
    "date_snapshot": _model_ctes() + """
select symbol, date, close_lag_1, sma_20, rsi_14, daily_return from ff where date = date '1998-06-15'""",
}


def feature_log_sql(bars: str | None = None) -> str:
    from barwise.plans.features import DECIMALS
    over = " or ".join(f"({c} is not null and try_cast({c} as decimal({p},{s})) is null)"
                       for c, (p, s) in DECIMALS.items())
    return features_body(bars=bars) + f""",
st as (select symbol, max(case when {over} then 1 else 0 end) as bad, count(*) as n from full_features group by symbol),
log_rows as (select symbol, 'features' as data_type, case when bad = 1 then 'failed' else 'success' end as status,
                    cast(case when bad = 1 then 0 else n end as bigint) as rows_affected,
                    case when bad = 1 then 'numeric overflow' end as error_msg, 'run-1' as dag_run_id,
                    timestamp '{RUN_TS}' as ran_at from st)
"""


BOOK_SQL = {
    "feature_run_log": feature_log_sql() + "select * from log_rows",
    "feature_summary": feature_log_sql() + """
select status, cast(count(*) as bigint) as n, cast(coalesce(sum(rows_affected), 0) as bigint) as rows
from log_rows where dag_run_id = 'run-1' and data_type = 'features' group by status""",
    "feature_symbols": feature_log_sql() + """
select cast(count(distinct symbol) as bigint) as n_symbols from log_rows where status = 'success'""",
}


def event_ingest_sql(kind: str) -> str:
    """A refetched event batch upserted into the stored event table."""
    from barwise.plans.ingest import SPECS
    from barwise.sources.fixtures import EVENT_TABLES, SNAPSHOT_CUT
    name, date_col = EVENT_TABLES[kind]
    spec = SPECS[kind]
    cols = {"dividends": ["symbol", "ex_date", "amount"], "splits": ["symbol", "split_date", "ratio"],
            "fundamentals": ["symbol", "as_of_date", "pe_ratio", "pb_ratio", "eps", "revenue", "net_income",
                             "debt_to_equity", "roe", "market_cap"]}[name]
    return f"""with symbol_registry as ({FIXTURE_SQL['symbol_registry']}),
ev as ({FIXTURE_SQL[name]}),
ledger as ({FIXTURE_SQL['split_ledger']}),
universe as (select symbol, yf_symbol from symbol_registry
  where symbol_type = 'equity' and series = 'EQ' and is_active and highlight and trim(yf_symbol) <> ''),
todo as (select yf_symbol as symbol from universe where yf_symbol not in (
  select symbol from ledger where data_type = '{kind}' and status = 'success'
  and cast(end_time as date) = date '{AS_OF}')),
stored as (select *, timestamp '2000-01-01 00:00:00' as ingested_at from ev where {date_col} < date '{SNAPSHOT_CUT}'),
batch as (select * from ev where symbol in (select symbol from todo)),
merged as ({upsert_sql('stored', 'batch', spec['keys'], cols + ['ingested_at'], cols, spec['update'],
                       {'ingested_at': f"timestamp '{RUN_TS}'"})})
select * from merged"""


# ---- rows that reach the rarer branches ---------------------------------------------------
# bars without open or close, infinite highs and lows (missing), a symbol of 59 bars, one whose return overflows
MESSY_BARS = f"""
  select symbol, date, case when day(date) = 13 then null else open end as open,
         case when day(date) = 27 then null else high end as high, case when day(date) = 27 then null else low end as low,
         case when day(date) = 14 then null else close end as close, volume
  from (select *, row_number() over (partition by symbol order by date) as k from ({FIXTURE_SQL['price_history']}) ph) numbered
  where symbol <> 'Brand#11' or k <= 59"""
SPIKED_BARS = f"""
  select symbol, date, open, high, low, case when symbol = 'Brand#21' and day(date) = 15 then close * 1e6 else close end as close, volume
  from ({FIXTURE_SQL['price_history']}) ph"""

MARKED_REGISTRY = """
  select 'S' || s_suppkey as symbol, case when s_nationkey % 4 = 0 then 'index' else 'equity' end as symbol_type,
         case when s_suppkey % 7 = 0 then '  ' when s_suppkey % 7 = 1 then null else 'S' || s_suppkey || '.NS' end as yf_symbol,
         case when s_nationkey = 5 then 'BE' else 'EQ' end as series,
         case when s_suppkey % 2 = 0 then 'Old sector' end as sector,
         case when s_suppkey % 3 = 0 then 'Old industry' end as industry,
         case when s_suppkey % 5 = 0 then 'Old name' end as name,
         case when s_suppkey % 11 <> 0 then date '1990-01-01' + cast(s_suppkey % 40 as integer) end as listing_date,
         s_nationkey <> 1 as is_active, s_nationkey % 3 <> 0 as highlight, timestamp '2000-01-01 00:00:00' as last_updated
  from supplier"""
_MARKED = f"with reg as ({MARKED_REGISTRY}), meta as ({FIXTURE_SQL['vendor_metadata']})"
_BACKLOG = "symbol_type = 'equity' and series = 'EQ' and (sector is null or industry is null)"

BRANCH_SQL = {
    "features_messy": features_sql(bars=MESSY_BARS),
    "quarantine_log": feature_log_sql(SPIKED_BARS) + "select * from log_rows",
    "marked_equities": _MARKED + """ select symbol, yf_symbol, sector, industry from reg
where symbol_type = 'equity' and series = 'EQ' and is_active and highlight and yf_symbol is not null and trim(yf_symbol) <> ''""",
    "marked_indices": _MARKED + """ select symbol, yf_symbol from reg
where symbol_type = 'index' and is_active and highlight and yf_symbol is not null and trim(yf_symbol) <> ''""",
    "registry_enriched": _MARKED + f""" select r.symbol, r.symbol_type, r.yf_symbol, r.series,
  case when {_BACKLOG.replace("sector is", "r.sector is").replace("industry is", "r.industry is")} and m.symbol is not null then coalesce(m.sector, r.sector) else r.sector end as sector,
  case when {_BACKLOG.replace("sector is", "r.sector is").replace("industry is", "r.industry is")} and m.symbol is not null then coalesce(m.industry, r.industry) else r.industry end as industry,
  case when {_BACKLOG.replace("sector is", "r.sector is").replace("industry is", "r.industry is")} and m.symbol is not null then coalesce(m.name, r.name) else r.name end as name,
  r.listing_date, r.is_active, r.highlight,
  case when {_BACKLOG.replace("sector is", "r.sector is").replace("industry is", "r.industry is")} and m.symbol is not null then timestamp '{RUN_TS}' else r.last_updated end as last_updated
from reg r left join meta m on m.symbol = r.symbol""",
    "backlog_newest": _MARKED + f""" select symbol, listing_date from reg where {_BACKLOG}
order by listing_date desc nulls last, symbol limit 5""",
    "features_upsert": _model_ctes() + f""",
stored as (select symbol, date, -1.0 as sma_20, -1.0 as rsi_14, timestamp '2000-01-01 00:00:00' as computed_at from ff where date < date '1999-01-01'),
batch as (select symbol, date, sma_20, rsi_14, timestamp '{RUN_TS}' as computed_at from ff where symbol <> 'Brand#13')
select coalesce(b.symbol, s.symbol) as symbol, coalesce(b.date, s.date) as date,
       case when b.symbol is not null then b.sma_20 else s.sma_20 end as sma_20,
       case when b.symbol is not null then b.rsi_14 else s.rsi_14 end as rsi_14,
       case when b.symbol is not null then b.computed_at else s.computed_at end as computed_at
from stored s full outer join batch b on b.symbol = s.symbol and b.date = s.date""",
    "predictions_upsert": _model_ctes() + """
select p.symbol, p.feature_date, p.prediction_date, p.predicted_direction, round(p.prob_up, 6) as prob_up,
       round(p.prob_down, 6) as prob_down, p.mlflow_run_id, p.dag_run_id,
       case when o.symbol is not null then timestamp '2000-01-01 00:00:00' else p.created_at end as created_at
from pred p left join prev o on o.symbol = p.symbol and o.feature_date = p.feature_date""",
    "documents_synced": _model_ctes() + """
select symbol, feature_date, prediction_date, predicted_direction, prob_up, prob_down, mlflow_run_id, dag_run_id, created_at from docs""",
}
