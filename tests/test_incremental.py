"""Incremental refresh: upsert semantics, lookback edges, incremental == full rebuild."""

import datetime as dt
import os

from pyspark.sql import functions as F

from gridmix.plans import intermediate as I
from gridmix.streaming.incremental import (
    lookback_cutoff, refresh_daily, refresh_generation_daily, refresh_weather_generation, rows_before,
    upsert,
)
from tests.helpers import d, hourly, rows


def _day(i):
    return (dt.date(2025, 1, 1) + dt.timedelta(days=i - 1)).isoformat()


def test_upsert_changed_new_untouched_vanished(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    schema = "k string, date date, v double"
    target = spark.createDataFrame([("a", d("2025-01-01"), 1.0), ("b", d("2025-01-01"), 2.0),
                                    ("c", d("2025-01-02"), 3.0)], schema)
    upsert(spark, target, path, ["k", "date"])
    updates = spark.createDataFrame([("a", d("2025-01-01"), 10.0), ("n", d("2025-01-02"), 9.0)],
                                    schema)
    upsert(spark, updates, path, ["k", "date"])
    got = rows(spark.read.parquet(path), "k", "date", "v", order=["k"])
    # changed -> updated, new -> inserted, untouched (c) kept, b (absent from updates) kept
    assert got == [("a", d("2025-01-01"), 10.0), ("b", d("2025-01-01"), 2.0),
                   ("c", d("2025-01-02"), 3.0), ("n", d("2025-01-02"), 9.0)]
    # idempotent
    upsert(spark, updates, path, ["k", "date"])
    assert rows(spark.read.parquet(path), "k", "date", "v", order=["k"]) == got


def test_generation_daily_lookback_edges(spark, tmp_dir):
    path = os.path.join(tmp_dir, "daily")
    first = [("DE", f"{_day(i)} 12:00", "Solar", 10, 100) for i in range(1, 11)]
    first.append(("DE", f"{_day(9)} 12:00", "Fossil Gas", 5, 100))
    assert refresh_generation_daily(spark, hourly(spark, first), path) is None
    assert lookback_cutoff(spark, path) == d(_day(7))
    second = [("DE", f"{_day(i)} 12:00", "Solar", 10, 100) for i in range(1, 12)]
    second = [r for r in second if r[1][:10] not in (_day(6), _day(7))]
    second += [("DE", f"{_day(6)} 12:00", "Solar", 66, 100),   # 4 days old: ignored
               ("DE", f"{_day(7)} 12:00", "Solar", 77, 100)]   # 3 days old: picked up
    assert refresh_generation_daily(spark, hourly(spark, second), path) == d(_day(7))
    got = {(r.date.isoformat(), r.energy_category): r.generation_mwh
           for r in spark.read.parquet(path).collect()}
    assert got[(_day(6), "renewable")] == 10.0
    assert got[(_day(7), "renewable")] == 77.0
    assert got[(_day(11), "renewable")] == 10.0
    assert got[(_day(9), "fossil")] == 5.0          # vanished from the source: kept
    assert len(got) == 12


def _synthetic_hourly(spark, days, countries=("DE", "FR")):
    data = []
    for c_i, c in enumerate(countries):
        for i in range(1, days + 1):
            wind = (i * 37 + c_i * 11) % 23 + (15 if i % 17 == 0 else 0)
            solar = (i * 13 + c_i * 5) % 19
            data.append((c, f"{_day(i)} 06:00", "Wind Onshore", wind, 500))
            data.append((c, f"{_day(i)} 12:00", "Solar", solar, 600))
            data.append((c, f"{_day(i)} 12:00", "Fossil Gas", 20, 600))
    return hourly(spark, data)


def _weather(spark, days, countries=("DE", "FR")):
    return spark.createDataFrame(
        [(c, d(_day(i)), float(i % 30), float(i % 12), 1.0, 2.0, 3.0)
         for c in countries for i in range(1, days + 1) if i % 10 != 0],
        "country_code string, date date, wind_speed_10m_max_kmh double, "
        "sunshine_duration_hrs double, temperature_avg_c double, precipitation_mm double, "
        "cloud_cover_pct double")


def test_weather_generation_incremental_equals_full(spark, tmp_dir):
    days = 150
    full_hourly = _synthetic_hourly(spark, days)
    weather = _weather(spark, days)
    full = I.int_weather_generation(I.generation_rollup(full_hourly), weather)

    path = os.path.join(tmp_dir, "wg")
    early = full_hourly.filter(F.col("datetime_utc") < F.lit(dt.datetime(2025, 5, 1)))
    assert refresh_weather_generation(spark, early, weather, path) is None
    cutoff = refresh_weather_generation(spark, full_hourly, weather, path)
    assert cutoff == d("2025-04-27")
    inc = spark.read.parquet(path).select(*full.columns)
    a = sorted(tuple(r) for r in inc.collect())
    b = sorted(tuple(r) for r in full.collect())
    assert len(a) == len(b) == 2 * days
    assert a == b
    assert any(r.is_wind_anomaly for r in inc.collect())


def test_both_daily_tables_from_one_rollup(spark, tmp_dir, monkeypatch):
    days = 150
    full_hourly, weather = _synthetic_hourly(spark, days), _weather(spark, days)
    rollups = []
    plain = I.generation_rollup
    monkeypatch.setattr(I, "generation_rollup", lambda df, **p: rollups.append(df) or plain(df, **p))
    daily, wg = os.path.join(tmp_dir, "daily2"), os.path.join(tmp_dir, "wg2")
    early = full_hourly.filter(F.col("datetime_utc") < F.lit(dt.datetime(2025, 5, 1)))
    assert refresh_daily(spark, early, weather, daily, wg) is None
    assert refresh_daily(spark, full_hourly, weather, daily, wg) == d("2025-04-27")
    assert len(rollups) == 2                                   # one for each run
    whole = plain(full_hourly)
    for path, full in ((daily, I.int_generation_daily(whole)), (wg, I.int_weather_generation(whole, weather))):
        got = spark.read.parquet(path).select(*full.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))


def test_rows_before_widens_for_sparse_keys(spark):
    dense = [("DE", d(_day(i)), i) for i in range(1, 101)]
    sparse = [("FR", d(_day(i)), i) for i in range(1, 101, 20)]
    gone = [("EE", d(_day(i)), i) for i in range(1, 4)]
    stored = spark.createDataFrame(dense + sparse + gone, "country_code string, date date, v int")
    keys = spark.createDataFrame([("DE",), ("FR",), ("EE",), ("LV",)], "country_code string")
    got = rows_before(stored, keys, d(_day(100)), 4)
    assert rows(got, "country_code", "v", order=["country_code", "v"]) == (
        [("DE", v) for v in (96, 97, 98, 99)] + [("EE", v) for v in (1, 2, 3)]
        + [("FR", v) for v in (21, 41, 61, 81)])
    only = rows_before(stored, keys.filter("country_code = 'DE'"), d(_day(100)), 4)
    assert only.count() == 4


def test_dev_sample_keeps_last_days(spark):
    from gridmix.streaming.incremental import since
    h = hourly(spark, [("DE", f"{_day(i)} 12:00", "Solar", 1, 1) for i in range(1, 11)])
    kept = since(h, "datetime_utc", d(_day(10)) - dt.timedelta(days=3))
    assert sorted(r.datetime_utc.day for r in kept.collect()) == [7, 8, 9, 10]
