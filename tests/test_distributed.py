"""Distributed rank and rolling windows equal the plain window functions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.operators.distributed import day_blocks, rank_desc_ranges, rolling_zscore_blocks, with_halo
from gridmix.operators.windows import rank_desc, rolling_zscore
from tests.helpers import rows


@pytest.mark.parametrize("range_values", [1, 7, 100_000])
def test_rank_with_one_year_holding_all_rows(spark, range_values):
    rng = np.random.default_rng(1)
    values = [None if i % 13 == 0 else float(rng.integers(0, 25)) for i in range(400)]
    data = [(2024, i, v) for i, v in enumerate(values)] + [(2025, 1, 1.0), (2025, 2, None), (None, 3, 2.0), (None, 4, 2.0), (None, 5, 1.0)]
    df = spark.createDataFrame(data, "year int, id int, v double").repartition(5)
    got = rank_desc_ranges(df, "v", ["year"], "r", range_values)
    assert got.columns == ["year", "id", "v", "r"] and dict(got.dtypes)["r"] == "bigint"
    assert sorted(map(str, got.collect())) == sorted(map(str, rank_desc(df, "v", ["year"], "r").collect()))
    assert rank_desc_ranges(df.limit(0), "v", ["year"], "r", range_values).count() == 0


def _series(spark, gaps):
    rng = np.random.default_rng(2)
    start = dt.date(2020, 1, 1)
    data = []
    for key, n in (("hot", 700), ("cold", 5), (None, 130)):
        day = start
        for _ in range(n):
            day += dt.timedelta(days=int(rng.choice([1, 1, 1, 2, 40] if gaps else [1])))
            data.append((key, day, None if rng.random() < 0.05 else float(rng.normal()), 1.0))
    return spark.createDataFrame(data, "k string, date date, v double, flat double").repartition(4)


@pytest.mark.parametrize("gaps,days,n", [(False, 100, 90), (True, 30, 12), (True, 7, 90), (False, 3, 10), (True, 400, 2), (False, 50, 1)])
def test_blocks_equal_one_window_per_key(spark, gaps, days, n):
    df = _series(spark, gaps)
    got = rolling_zscore_blocks(df, {"v": "z", "flat": "zf"}, ["k"], "date", day_blocks("date", days), n)
    want = rolling_zscore(rolling_zscore(df, "v", ["k"], "date", "z", n), "flat", ["k"], "date", "zf", n)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_halos_hold_what_blocks_need_and_no_more(spark):
    df = _series(spark, True)
    halo = with_halo(df, ["k"], "date", day_blocks("date", 20), 9)
    assert halo.filter(~F.col("_halo")).count() == df.count()
    series = {}
    for k, day in sorted(rows(df, "k", "date"), key=lambda r: r[1]):
        series.setdefault(k, []).append(day)
    blocks = {}
    for r in halo.collect():
        blocks.setdefault((r["k"], r["_block"]), ([], []))[r["_halo"]].append(r["date"])
    for (k, _), (own, copied) in blocks.items():
        first = series[k].index(min(own))
        assert sorted(copied) == series[k][max(0, first - 9):first]


def test_no_window_over_a_whole_key_of_rows(spark):
    """Only counts of blocks and ranges are windowed by key; rows are windowed by (key, block)."""
    df = _series(spark, False)
    plan = rolling_zscore_blocks(df, {"v": "z"}, ["k"], "date", day_blocks("date", 100), 90)._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.splitlines() if "Window [" in line and "WindowGroupLimit" not in line]
    whole = [s for s in specs if "_block" not in s.split("], [")[1]]
    assert len(whole) == 1 and "collect_list" in whole[0]
