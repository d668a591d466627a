"""Stream of landed files, change sets of late rows, co-moments, bitmaps: each equals a full rebuild."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.operators.comoments import correlation, merge_states, state
from gridmix.operators.day_bitmaps import count_days, qualifying_blocks
from gridmix.plans import intermediate as I
from gridmix.plans import marts as M
from gridmix.streaming import stream
from gridmix.streaming.correlations import month_blocks, refresh_blocks, seasonal_correlation
from gridmix.streaming.incremental import (
    newest_load, put_changed, refresh_changed, touched_days, upsert,
)
from gridmix.sources.sinks import Staging, finished, folders
from tests.helpers import d, hourly
from tests.test_incremental import _day, _synthetic_hourly, _weather

N = 7  # a short z-score window keeps the tables small


def _full(spark, rows, weather):
    rollup = I.generation_rollup(rows)
    return I.int_generation_daily(rollup), I.int_weather_generation(rollup, weather, n=N)


def _same(spark, path, full):
    got = spark.read.parquet(path).select(*full.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))


def _land(rows, path, parts):
    rows.withColumn("_loaded_at", F.col("datetime_utc")).repartition(parts, F.xxhash64(*rows.columns)).write.mode("append").parquet(path)


def _run(spark, tmp, weather, **more):
    return stream.refresh_stream(spark, f"{tmp}/landing", weather, f"{tmp}/daily", f"{tmp}/wg", f"{tmp}/ledger",
                                 f"{tmp}/checkpoint", n=N, partition_col="month", **more)


def _some_rows(spark, days=60):
    rows = _synthetic_hourly(spark, days)
    odd = hourly(spark, [("DE", f"{_day(5)} 03:00", "Solar", None, None), ("FR", f"{_day(5)} 03:00", None, 2.5, 1),
                         (None, f"{_day(6)} 03:00", "Solar", 1, 1)])
    return rows.unionByName(odd)


def test_stream_equals_full_rebuild_and_goes_on(spark, tmp_dir):
    rows, weather = _some_rows(spark), _weather(spark, 60)
    early = rows.filter(F.col("datetime_utc") < F.lit(dt.datetime(2025, 2, 10)))
    _land(early, f"{tmp_dir}/landing", 3)
    assert _run(spark, tmp_dir, weather, files_per_batch=1, compact_every=2) >= 2
    for path, full in zip((f"{tmp_dir}/daily", f"{tmp_dir}/wg"), _full(spark, early, weather)):
        _same(spark, path, full)
    _land(rows.exceptAll(early), f"{tmp_dir}/landing", 2)
    assert _run(spark, tmp_dir, weather, files_per_batch=1, compact_every=2) >= 1
    assert _run(spark, tmp_dir, weather) == 0                       # nothing new
    for path, full in zip((f"{tmp_dir}/daily", f"{tmp_dir}/wg"), _full(spark, rows, weather)):
        _same(spark, path, full)
    own = folders(spark, f"{tmp_dir}/ledger")
    assert len(own) == 1
    kept = folders(spark, f"{tmp_dir}/ledger/{own[0]}")
    assert sum(k.startswith("base-") for k in kept) <= 2 and "batch-0" not in kept


@pytest.mark.parametrize("ended_after", ["record", "daily", "weather", "compact"])
def test_replay_of_a_broken_batch(spark, tmp_dir, monkeypatch, ended_after):
    """The second batch ends after some of its writes, before the stream's own commit."""
    rows, weather = _some_rows(spark, 30), _weather(spark, 30)
    _land(rows, f"{tmp_dir}/landing", 3)
    runs = {"record": 0, "daily": 0, "weather": 0, "compact": 0}

    def breaking(kind, fn):
        def call(*args, **kwargs):
            out = fn(*args, **kwargs)
            runs[kind] += 1
            if kind == ended_after and runs[kind] == 2:
                raise RuntimeError("ended")
            return out
        return call

    from gridmix.streaming import incremental
    plain = incremental.upsert
    monkeypatch.setattr(stream.DailyLedger, "record", breaking("record", stream.DailyLedger.record))
    monkeypatch.setattr(stream.DailyLedger, "compact", breaking("compact", stream.DailyLedger.compact))
    daily, wg = breaking("daily", plain), breaking("weather", plain)
    monkeypatch.setattr(incremental, "upsert", lambda s, df, path, *a, **k: (daily if path.endswith("daily") else wg)(s, df, path, *a, **k))
    with pytest.raises(Exception, match="ended"):
        _run(spark, tmp_dir, weather, files_per_batch=1, compact_every=2)
    monkeypatch.undo()
    assert _run(spark, tmp_dir, weather, files_per_batch=1, compact_every=2) >= 1
    for path, full in zip((f"{tmp_dir}/daily", f"{tmp_dir}/wg"), _full(spark, rows, weather)):
        _same(spark, path, full)


def test_a_new_checkpoint_does_not_count_twice(spark, tmp_dir):
    rows, weather = _some_rows(spark, 12), _weather(spark, 12)
    _land(rows, f"{tmp_dir}/landing", 1)
    _run(spark, tmp_dir, weather)
    with pytest.raises(Exception, match="another stream"):
        stream.refresh_stream(spark, f"{tmp_dir}/landing", weather, f"{tmp_dir}/daily", f"{tmp_dir}/wg",
                              f"{tmp_dir}/ledger", f"{tmp_dir}/other-checkpoint", n=N, partition_col="month")
    _same(spark, f"{tmp_dir}/daily", _full(spark, rows, weather)[0])


def _files(path):
    return {os.path.join(r, f): os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_row_forty_days_late_rewrites_only_what_it_touches(spark, tmp_dir):
    days = 90
    rows = _synthetic_hourly(spark, days).withColumn("_loaded_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    weather = _weather(spark, days)
    late = hourly(spark, [("DE", f"{_day(days - 40)} 09:00", "Wind Onshore", 321.5, 700),
                          ("FR", f"{_day(days - 60)} 09:00", "Hydro Water Reservoir", 4, 600),
                          ("EE", f"{_day(20)} 09:00", "Solar", 5, 50)]).withColumn("_loaded_at", F.lit("2026-02-02 00:00:00").cast("timestamp"))
    daily, wg = f"{tmp_dir}/daily", f"{tmp_dir}/wg"
    with Staging(spark) as staging:
        put_changed(spark, staging, staging.put(I.generation_rollup(rows)), weather, daily, wg, n=N)
    mark = newest_load(rows)
    before = {p: _files(p) for p in (daily, wg)}
    whole = rows.unionByName(late)
    assert refresh_changed(spark, whole, weather, daily, wg, mark, n=N) == dt.datetime(2026, 2, 2)
    for path, full in zip((daily, wg), _full(spark, whole, weather)):
        _same(spark, path, full)

    def rewritten(path):
        after = _files(path)
        return {os.path.basename(os.path.dirname(f)).split("=")[1] for f, _ in set(before[path].items()) ^ set(after.items())}
    assert rewritten(daily) == {_day(days - 40), _day(days - 60), _day(20)}
    # The z-scores of the N - 1 days after a late row change too.
    assert rewritten(wg) == {_day(first + i) for first in (days - 40, days - 60) for i in range(N)} | {_day(20)}
    # The same mark again, and a mark after all loads, change nothing.
    refresh_changed(spark, whole, weather, daily, wg, mark, n=N)
    untouched = {p: _files(p) for p in (daily, wg)}
    refresh_changed(spark, whole, weather, daily, wg, newest_load(whole), n=N)
    assert untouched == {p: _files(p) for p in (daily, wg)}
    for path, full in zip((daily, wg), _full(spark, whole, weather)):
        _same(spark, path, full)


def test_staging_is_removed(spark, tmp_dir):
    from gridmix.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    before = [f for f in folders(spark, root) if "stage" in f]
    updates = spark.createDataFrame([("a", d("2025-01-01"), 1.0)], "k string, date date, v double")
    for _ in range(2):
        upsert(spark, updates, f"{tmp_dir}/t", ["k", "date"])
    with pytest.raises(ValueError), Staging(spark) as staging:
        staging.put(updates)
        raise ValueError
    assert [f for f in folders(spark, root) if "stage" in f] == before


# Co-moments


def _pairs(seed, n, shift):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = rng.gauss(0, 1) + shift
        rows.append(("g", i % 7, None if i % 11 == 0 else x, None if i % 13 == 0 else 0.5 * x + rng.gauss(0, 1)))
    rows += [("flat", i % 3, 0.1, float(i)) for i in range(9)] + [("one", 0, 1.0, 2.0), ("none", 0, None, 1.0)]
    return rows


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_merged_blocks_equal_the_whole(spark, shift):
    rows = _pairs(3, 400, shift)
    df = spark.createDataFrame(rows, "k string, block int, x double, y double")
    blocks = df.groupBy("k", "block").agg(state("x", "y").alias("s"), F.count("*").alias("rows"))
    got = {r["k"]: r for r in merge_states(blocks, ["k"], "block", ["s"], ["rows"]).select(
        "k", "s", "rows", correlation(F.col("s"), None).alias("r")).collect()}
    xs, ys = zip(*[(x, y) for k, _, x, y in rows if k == "g" and x is not None and y is not None])
    s = got["g"]["s"]
    assert s["n"] == len(xs) and got["g"]["rows"] == 400
    assert got["g"]["r"] == pytest.approx(np.corrcoef(xs, ys)[0, 1], rel=1e-9)
    assert s["m2_x"] == pytest.approx(np.var(xs) * len(xs), rel=1e-8)
    # Equal values in all blocks stay equal: undefined, not noise.
    assert got["flat"]["r"] is None and got["one"]["r"] is None and got["none"]["r"] is None
    assert got["none"]["s"]["n"] == 0


def test_blocks_follow_late_days_without_history(spark, tmp_dir):
    days, path = 200, f"{tmp_dir}/blocks"
    weather = _weather(spark, days)
    table = I.int_weather_generation(I.generation_rollup(_synthetic_hourly(spark, days)), weather, n=N)
    late_day = d(_day(40))
    refresh_blocks(spark, table.filter((F.col("date") != F.lit(late_day)) & (F.col("date") < F.lit(d(_day(180))))), path)
    old = _files(path)
    changed = [late_day] + [d(_day(i)) for i in range(180, days + 1)]
    for _ in range(2):  # twice: nothing counts double
        refresh_blocks(spark, table, path, changed)
        want = M.seasonal_correlation(table)
        got = seasonal_correlation(spark.read.parquet(path)).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    months = {f.split("month=")[1][:10] for f, _ in set(old.items()) ^ set(_files(path).items())}
    assert months == {"2025-02-01", "2025-06-01", "2025-07-01"}
    assert "2025-03-01" in {f.split("month=")[1][:10] for f in old}
    refresh_blocks(spark, table, path, [])
    assert month_blocks(table.limit(0)).count() == 0


def test_bitmaps_count_days_once(spark):
    rows = [("DE", d(f"2024-{m:02d}-{day:02d}"), cat, float(v)) for m in (1, 2, 12) for day in range(1, 29)
            for cat, v in (("renewable", 90 if (day + m) % 3 else 10), ("fossil", 10))]
    rows.append(("DE", d("2024-12-31"), "renewable", 5.0))
    rows.append(("FR", d("2024-01-01"), "fossil", 5.0))
    df = spark.createDataFrame(rows, "country_code string, date date, cat string, v double")
    blocks = qualifying_blocks(df, ["country_code"], "date", "v", F.col("cat") == "renewable", 80)
    want = {"DE": sum((day + m) % 3 != 0 for m in (1, 2, 12) for day in range(1, 29)) + 1, "FR": 0}
    for b in (blocks, blocks.unionByName(blocks)):
        assert {r[0]: r["renewable_independence_days"] for r in count_days(b, ["country_code"]).collect()} == want


def test_touched_days_and_finished(spark, tmp_dir):
    df = spark.createDataFrame([("a", None), ("a", d("2025-01-02")), ("b", d("2025-01-01")), ("a", d("2025-01-02"))],
                               "country_code string, date date")
    assert touched_days(df) == [d("2025-01-01"), d("2025-01-02")]
    df.write.parquet(f"{tmp_dir}/t")
    assert finished(spark, f"{tmp_dir}/t") and not finished(spark, f"{tmp_dir}/gone")
    assert folders(spark, f"{tmp_dir}/gone") == []
