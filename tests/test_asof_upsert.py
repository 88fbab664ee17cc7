import datetime as dt

from pyspark.sql import functions as F

from barwise.operators.asof import asof_join, days_since
from barwise.operators.upsert import dedupe_batch, upsert, upsert_stats

D = dt.date


def test_asof_ties_and_whole_row(spark):
    left = spark.createDataFrame([("A", D(2020, 1, 1)), ("A", D(2020, 1, 5)), ("A", D(2020, 1, 9)),
                                  ("B", D(2020, 1, 5))], "symbol string, date date")
    right = spark.createDataFrame([("A", D(2020, 1, 5), 1.0, 10.0), ("A", D(2020, 1, 8), None, 20.0)],
                                  "symbol string, as_of date, pe double, pb double")
    out = {(r.symbol, r.date): (r.pe, r.pb) for r in
           asof_join(left, right, "symbol", "date", "as_of", ["pe", "pb"]).collect()}
    assert out[("A", D(2020, 1, 1))] == (None, None)        # before first snapshot
    assert out[("A", D(2020, 1, 5))] == (1.0, 10.0)         # tie included
    assert out[("A", D(2020, 1, 9))] == (None, 20.0)        # NULL field not back-filled
    assert out[("B", D(2020, 1, 5))] == (None, None)        # key without snapshots


def test_days_since_counts_off_calendar_events(spark):
    left = spark.createDataFrame([("A", D(2020, 1, 6)), ("A", D(2020, 1, 10))], "symbol string, date date")
    ev = spark.createDataFrame([("A", D(2020, 1, 4)), ("A", D(2020, 1, 10))], "symbol string, d date")
    out = {r.date: r.n for r in days_since(left, ev, "symbol", "date", "d", "n").collect()}
    assert out == {D(2020, 1, 6): 2, D(2020, 1, 10): 0}


def _tables(spark):
    t = spark.createDataFrame([("A", D(2020, 1, 1), 1.0, 100, "old"), ("A", D(2020, 1, 2), 2.0, 200, "old")],
                              "symbol string, date date, close double, volume bigint, ingested string")
    s = spark.createDataFrame([("A", D(2020, 1, 2), 2.5, None), ("A", D(2020, 1, 3), 3.0, 300)],
                              "symbol string, date date, close double, volume bigint")
    return t, s


def test_upsert_partial_update_and_idempotence(spark):
    t, s = _tables(spark)
    once = upsert(t, s, ["symbol", "date"], ["close", "volume"], insert_defaults={"ingested": F.lit("new")})
    rows = {r.date: r for r in once.collect()}
    assert rows[D(2020, 1, 1)].close == 1.0 and rows[D(2020, 1, 1)].ingested == "old"
    assert rows[D(2020, 1, 2)].close == 2.5 and rows[D(2020, 1, 2)].volume is None   # NULL overwrites
    assert rows[D(2020, 1, 2)].ingested == "old"                                      # kept column
    assert rows[D(2020, 1, 3)].ingested == "new"
    twice = upsert(once, s, ["symbol", "date"], ["close", "volume"], insert_defaults={"ingested": F.lit("new")})
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_dedupe_last_wins_and_stats(spark):
    b = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 9.0), ("B", 1, 5.0)], "symbol string, seq int, v double")
    d = {r.symbol: r.v for r in dedupe_batch(b, ["symbol"], "seq").collect()}
    assert d == {"A": 9.0, "B": 5.0}
    t, s = _tables(spark)
    st = upsert_stats(t, s, ["symbol", "date"], ["close", "volume"]).first()
    assert (st.inserted, st.modified, st.total) == (1, 1, 2)


def test_fallback_universe_only_when_registry_selects_nothing(spark):
    from barwise.operators import universe as U
    reg = spark.createDataFrame([("X", "equity", "X.NS", "EQ", True, False, "s", "i")],
                                "symbol string, symbol_type string, yf_symbol string, series string, "
                                "is_active boolean, highlight boolean, sector string, industry string")
    empty = U.universe_or_fallback(U.equity_universe(reg), U.fallback_equities(spark))
    assert empty.count() == len(U.FALLBACK_EQUITIES)
    hl = reg.withColumn("highlight", F.lit(True))
    got = U.universe_or_fallback(U.equity_universe(hl), U.fallback_equities(spark)).collect()
    assert [r.yf_symbol for r in got] == ["X.NS"]
