"""Versioned tables: readers, two writers at once, a killed writer, and merges that rewrite what they touch."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from barwise.operators import snapshots as S

KEYS, UPDATE = ["symbol", "date"], ["close"]
SCHEMA = "symbol string, date date, close double, ingested string"


def bars(spark, symbols, days, close, tag="old"):
    return spark.createDataFrame([(s, d, float(close), tag) for s in symbols for d in days], SCHEMA)


def ten_years(spark):
    day = [dt.date(2010, 1, 15) + dt.timedelta(days=30 * i) for i in range(120)]
    return bars(spark, [f"S{i:02d}" for i in range(8)], day, 1)


def rows(df):
    return sorted(map(tuple, df.select("symbol", "date", "close", "ingested").collect()))


def test_a_day_rewrites_its_month_only(spark, tmp_path):
    t = str(tmp_path / "bars")
    first = S.replace(spark, t, ten_years(spark), KEYS, F.date_format("date", "yyyy-MM"))
    day = dt.date(2015, 6, 30)
    month = [f for f in first.files if f.part == "2015-06"]
    got = S.merge(spark, t, bars(spark, ["S03", "new"], [day], 7, "b").drop("ingested"), KEYS, UPDATE, "date", insert_defaults={"ingested": F.lit("now")})
    gone = [f for f in first.files if f not in got.files]
    assert gone and set(gone) <= set(month) and {f.part for f in got.files if f not in first.files} == {"2015-06"}
    assert len([f for f in got.files if f in first.files]) == len(first.files) - len(gone) >= 116
    want = rows(ten_years(spark)) + [("S03", day, 7.0, "now"), ("new", day, 7.0, "now")]
    assert rows(S.read(spark, t)) == sorted(want) and rows(S.read(spark, t, first.number)) == rows(ten_years(spark))
    again = S.merge(spark, t, bars(spark, ["S03", "new"], [day], 7, "b").drop("ingested"), KEYS, UPDATE, "date", insert_defaults={"ingested": F.lit("later")})
    assert rows(S.read(spark, t)) == sorted(want) and again.number == got.number + 1
    assert sum(f.rows for f in again.files) == len(want)
    # matched rows take the new value and keep the stored columns; a key range that holds no key of the batch is carried
    S.merge(spark, t, bars(spark, ["zzz"], [day], 3), KEYS, UPDATE, "date")
    assert set(again.files) <= set(S.version(spark, t).files)
    assert S.merge(spark, t, bars(spark, [], [], 0), KEYS, UPDATE, "date").number == again.number + 1
    assert S.read(spark, t, part=["2015-06"]).count() == 8 + 3


def test_merge_into_nothing_and_rows_without_a_date(spark, tmp_path):
    t = str(tmp_path / "t")
    assert not S.exists(spark, t)
    with pytest.raises(ValueError):
        S.read(spark, t)
    batch = bars(spark, ["A", "A"], [dt.date(2020, 1, 1), None], 1)
    S.merge(spark, t, batch, KEYS, UPDATE, "date")
    assert rows(S.read(spark, t)) == [("A", dt.date(2020, 1, 1), 1.0, "old")]
    e = str(tmp_path / "e")
    S.merge(spark, e, batch.limit(0), KEYS, UPDATE, "date")
    assert S.read(spark, e).count() == 0 and S.read(spark, e).columns == batch.columns
    S.append(spark, str(tmp_path / "log"), batch)
    assert S.append(spark, str(tmp_path / "log"), batch).number == 1 and S.read(spark, str(tmp_path / "log")).count() == 8


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    S.replace(spark, t, ten_years(spark), KEYS, F.date_format("date", "yyyy-MM"))
    errors = []

    def write(name):
        try:
            for i in range(2):
                S.merge(spark, t, bars(spark, [f"{name}{i}"], [dt.date(2012, 3, 1)], i), KEYS, UPDATE, "date")
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    writers = [threading.Thread(target=write, args=(n,)) for n in ("x", "y", "z")]
    [w.start() for w in writers]
    seen = [S.read(spark, t).count() for _ in range(4)]           # a reader in between always sees a whole version
    [w.join() for w in writers]
    assert not errors and S.versions(spark, t) == list(range(7))
    assert seen == sorted(seen) and all(8 * 120 <= n <= 8 * 120 + 6 for n in seen)
    assert sorted(r.symbol for r in S.read(spark, t).where("date = '2012-03-01'").collect()) == ["x0", "x1", "y0", "y1", "z0", "z1"]


def test_a_version_number_is_published_once(spark, tmp_path):
    t = str(tmp_path / "t")
    v = S.replace(spark, t, bars(spark, ["A"], [dt.date(2020, 1, 1)], 1))
    assert not S._publish(spark, t, S.Version(v.number, v.schema)) and len(S.read(spark, t).collect()) == 1
    assert S._publish(spark, t, S.Version(v.number + 1, v.schema)) and S.read(spark, t).count() == 0


def test_a_killed_writer_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    S.replace(spark, t, ten_years(spark), KEYS, F.date_format("date", "yyyy-MM"))
    before = rows(S.read(spark, t))

    def killed(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(S, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            S.merge(spark, t, bars(spark, ["S01"], [dt.date(2010, 1, 15)], 9), KEYS, UPDATE, "date")
    assert rows(S.read(spark, t)) == before and S.versions(spark, t) == [0]
    S.merge(spark, t, bars(spark, ["S01"], [dt.date(2010, 1, 15)], 9), KEYS, UPDATE, "date")
    after = rows(S.read(spark, t))
    assert after != before and len(after) == len(before)
    assert S.expire(spark, t, keep=1) >= 1 and rows(S.read(spark, t)) == after
    assert S.versions(spark, t) == [1]
