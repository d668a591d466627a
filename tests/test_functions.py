"""Column functions: rounding, guarded ratios, shares, correlation, calendar, classification."""

import datetime as dt

from pyspark.sql import functions as F

from gridmix.constants import CATEGORY_MAP
from gridmix.functions import (
    classify, exact_sum, masked_avg, period, round_half_up, safe_corr, safe_ratio, season,
    share_pct, utc_day,
)
from gridmix.functions.scores import emissions_avoided, resilience, target_gap, target_progress
from tests.helpers import d, ts


def one(spark, expr, schema="x double", data=((1.0,),)):
    return spark.createDataFrame(list(data), schema).select(expr.alias("v")).first()["v"]


def test_round_half_up_ties_and_negatives(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (-0.285,), (2.675,), (None,)], "x double")
    got = [r.v for r in df.select(round_half_up("x", 2).alias("v")).collect()]
    assert got == [1.01, 0.29, -0.29, 2.68, None]


def test_safe_ratio_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double")
    assert [r.v for r in df.select(safe_ratio("a", "b").alias("v")).collect()] == [None, 0.25, None]


def test_share_pct_and_exact_sum(spark):
    df = spark.createDataFrame([("r", 0.1), ("r", 0.2), ("f", 0.3), ("x", 0.0)],
                               "c string, v double")
    row = df.agg(share_pct("v", F.col("c") == "r").alias("s"),
                 exact_sum("v").alias("t")).first()
    assert row.s == 50.0 and row.t == 0.6  # 0.1 + 0.2 + 0.3 exactly 0.6
    zero = spark.createDataFrame([("r", 0.0)], "c string, v double")
    assert zero.agg(share_pct("v", F.col("c") == "r").alias("s")).first().s is None


def test_masked_avg_ignores_other_rows(spark):
    df = spark.createDataFrame([("r", 10.0), ("r", 20.0), ("f", 99.0)], "c string, v double")
    assert df.agg(masked_avg("v", F.col("c") == "r").alias("m")).first().m == 15.0


def test_safe_corr_null_when_undefined(spark):
    one_pair = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    perfect = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0)],
                                    "x double, y double")
    assert one_pair.agg(safe_corr("x", "y").alias("c")).first().c is None
    assert const.agg(safe_corr("x", "y").alias("c")).first().c is None
    assert perfect.agg(safe_corr("x", "y").alias("c")).first().c == 1.0


def test_utc_day_and_season(spark):
    df = spark.createDataFrame([(ts("2024-12-31 23:30"),), (ts("2025-01-01 00:00"),),
                                (ts("2025-02-28 12:00"),), (ts("2025-03-01 00:00"),)],
                               "t timestamp")
    got = [(r.day, r.s) for r in df.select(utc_day("t").alias("day"),
                                           season(utc_day("t")).alias("s")).collect()]
    assert got == [(d("2024-12-31"), "winter"), (d("2025-01-01"), "winter"),
                   (d("2025-02-28"), "winter"), (d("2025-03-01"), "spring")]


def test_period_boundary_day_is_after(spark):
    df = spark.createDataFrame([(d("2025-01-31"),), (d("2025-02-01"),)], "x date")
    got = [r.p for r in df.select(period("x", "2025-02-01").alias("p")).collect()]
    assert got == ["pre_brell", "post_brell"]


def test_classify_unknown_is_other(spark):
    df = spark.createDataFrame([("Solar",), ("Fossil Gas",), ("Nuclear",), ("Biomass",),
                                (None,)], "p string")
    got = [r.c for r in df.select(classify("p", CATEGORY_MAP).alias("c")).collect()]
    assert got == ["renewable", "fossil", "nuclear", "other", "other"]


def test_scores_null_target_and_zero_progress(spark):
    df = spark.createDataFrame([(60.0, 20.0, 42.5), (60.0, 20.0, None), (0.0, 50.0, 42.5)],
                               "share double, fossil double, target double")
    out = df.select(target_progress("share", "target").alias("p"),
                    target_gap("share", "target").alias("g")).collect()
    assert [(r.p, r.g) for r in out] == [(141.18, -17.5), (None, None), (0.0, 42.5)]
    scored = df.select(resilience("share", "fossil", target_progress("share", "target"))
                       .alias("r")).collect()
    # 60*.5 + 80*.3 + 141.18*.2 = 82.236 -> 82.24; NULL target -> NULL; progress 0 -> NULL
    assert [r.r for r in scored] == [82.24, None, None]


def test_emissions_avoided_formula(spark):
    df = spark.createDataFrame([(250.0, 1_000_000.0), (None, 5.0)], "i double, m double")
    assert [r.v for r in df.select(emissions_avoided("i", "m").alias("v")).collect()] == [50.0, None]


def test_dates_are_dates(spark):
    assert one(spark, F.date_sub(F.lit(dt.date(2025, 3, 1)), 3)) == dt.date(2025, 2, 26)


def test_measures_keep_their_digits(spark):
    """24 rows of 0.004 and 24 of 0.125: sums and shares below a hundredth are not lost; NaN is missing."""
    from gridmix.functions.numeric import exact_avg, exact_sum, share_pct

    rows = [("r", 0.004)] * 24 + [("f", 0.125)] * 24 + [("f", float("nan")), ("f", None)]
    df = spark.createDataFrame(rows, "kind string, mwh double")
    by_kind = {r["kind"]: r for r in df.groupBy("kind").agg(exact_sum("mwh").alias("s"), exact_avg("mwh").alias("a")).collect()}
    assert (by_kind["r"]["s"], by_kind["f"]["s"]) == (0.096, 3.0)
    assert (by_kind["r"]["a"], by_kind["f"]["a"]) == (0.004, 0.125)
    assert df.agg(share_pct("mwh", df["kind"] == "r").alias("p")).first()["p"] == 3.1
