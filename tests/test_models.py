"""Golden tests of the models on tiny hand-written real-shape inputs (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmix.operators import quality as Q
from gridmix.operators.windows import flag_anomaly, rolling_zscore
from gridmix.plans import intermediate as I
from gridmix.plans import marts as M
from tests.helpers import d, daily, hourly, rows


def test_daily_rollup_day_boundary_categories_and_mean_load(spark):
    h = hourly(spark, [
        ("DE", "2024-12-31 23:30", "Solar", 10, 100),
        ("DE", "2025-01-01 00:00", "Solar", 20, 200),
        ("DE", "2025-01-01 01:00", "Solar", 30, 300),
        ("DE", "2025-01-01 00:00", "Wind Onshore", 5, 200),
        ("DE", "2025-01-01 00:00", "Biomass", 7, 200),
        ("DE", "2025-01-01 00:00", "Fossil Gas", 8, 200),
    ])
    roll = I.generation_rollup(h)
    got = rows(I.int_generation_daily(roll), order=["date", "energy_category"])
    assert got == [
        ("DE", d("2024-12-31"), "renewable", "winter", 10.0, 100.0),
        ("DE", d("2025-01-01"), "fossil", "winter", 8.0, 200.0),
        ("DE", d("2025-01-01"), "other", "winter", 7.0, 200.0),
        ("DE", d("2025-01-01"), "renewable", "winter", 55.0, 700.0 / 3),
    ]
    wg = I.weather_daily_generation(roll).filter(F.col("date") == d("2025-01-01")).first()
    assert (wg.renewable_mwh, wg.wind_generation_mwh, wg.solar_generation_mwh,
            wg.total_generation_mwh) == (55.0, 5.0, 50.0, 70.0)


def _series(spark, values, country="DE", start="2024-01-01"):
    s = d(start)
    return spark.createDataFrame(
        [(country, s + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
        "country_code string, date date, x double")


def test_rolling_zscore_first_row_constant_and_frame_end(spark):
    z = rolling_zscore(_series(spark, [1000] + [0] * 90), "x", ["country_code"], "date", "z")
    zs = [r.z for r in z.orderBy("date").collect()]
    assert zs[0] is None                 # one row: sample stddev undefined
    assert zs[89] is not None            # row 90: row 1 still in the frame
    assert zs[90] is None                # row 91: row 1 left, frame constant -> stddev 0
    const = rolling_zscore(_series(spark, [7] * 5), "x", ["country_code"], "date", "z")
    assert all(r.z is None for r in const.collect())


def test_anomaly_flag_on_rounded_z(spark):
    df = spark.createDataFrame([(2.5,), (2.51,), (-2.51,), (None,)], "z double")
    assert [r.f for r in flag_anomaly(df, "z", "f").collect()] == [False, True, True, None]


def test_independence_days_strict_on_rounded_share(spark):
    dd = daily(spark, [
        ("NO", "2024-01-01", "renewable", 80.0, None), ("NO", "2024-01-01", "fossil", 20.0, None),
        ("NO", "2024-01-02", "renewable", 2000.10, None), ("NO", "2024-01-02", "fossil", 499.90, None),
        ("NO", "2024-01-03", "renewable", 80.01, None), ("NO", "2024-01-03", "fossil", 19.99, None),
        ("NO", "2024-01-04", "renewable", 0.0, None), ("NO", "2024-01-04", "fossil", 0.0, None),
    ])
    from gridmix.operators.aggregates import count_qualifying_days
    got = rows(count_qualifying_days(dd, ["country_code"], "date", "generation_mwh",
                                     F.col("energy_category") == "renewable", 80))
    assert got == [("NO", 2024, 1)]


def _profile(spark, data):
    return spark.createDataFrame(
        [(c, c, 2024, s, 100.0 - s, 1000.0, 5.0, True, t) for c, s, t in data],
        "country_code string, country_name string, year bigint, renewable_share_pct double, "
        "fossil_dependency_score double, total_generation_mwh double, total_load_mwh double, "
        "is_eu_member boolean, eu_target_2030_pct double")


def _groups(spark):
    return spark.createDataFrame(
        [("A", "core", ""), ("B", "core", ""), ("C", "core", ""), ("LT", "geopolitical", ""),
         ("LT", "baltic", "")], "country_code string, group_name string, group_description string")


def test_group_metrics_ties_and_rank_overall_counts_country_once(spark):
    prof = _profile(spark, [("A", 50.0, 42.5), ("B", 50.0, 42.5), ("C", 40.0, 42.5),
                            ("LT", 60.0, 42.5)])
    gm = I.int_country_group_metrics(prof, _groups(spark))
    got = rows(gm, "country_code", "group_name", "group_avg_renewable_pct", "delta_from_group_avg",
               "rank_within_group", "rank_overall", order=["country_code", "group_name"])
    assert got == [
        ("A", "core", 46.67, 3.33, 1, 2),
        ("B", "core", 46.67, 3.33, 1, 2),
        ("C", "core", 46.67, -6.67, 3, 4),
        ("LT", "baltic", 60.0, 0.0, 1, 1),
        ("LT", "geopolitical", 60.0, 0.0, 1, 1),
    ]


def test_independence_and_resilience_null_target(spark):
    prof = _profile(spark, [("NO", 90.0, None), ("A", 50.0, 42.5)]).withColumns(
        {"latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    dd = daily(spark, [("NO", "2024-05-01", "renewable", 90.0, None),
                       ("NO", "2024-05-01", "fossil", 10.0, None),
                       ("A", "2024-05-01", "renewable", 50.0, None),
                       ("A", "2024-05-01", "fossil", 50.0, None)])
    annual = spark.createDataFrame([("NOR", 2024, 30.0), ("XXX", 2024, 1.0)],
                                   "country_code_iso3 string, year bigint, co2_intensity_gco2_kwh double")
    xw = spark.createDataFrame([("NO", "NOR"), ("A", "AAA")], "country_code string, country_code_iso3 string")
    ind = M.mart_country_independence(prof, dd, annual, xw)
    got = {r.country_code: r for r in ind.collect()}
    assert got["NO"].pct_progress_toward_2030_target is None
    assert got["NO"].gap_to_2030_target_pct is None
    assert got["NO"].renewable_independence_days == 1
    assert got["NO"].co2_avoided_tonnes == 0.27          # (300-30)*1000/1e6
    assert got["A"].pct_progress_toward_2030_target == 117.65
    assert got["A"].co2_avoided_tonnes is None            # no annual statistics
    gm = I.int_country_group_metrics(prof, spark.createDataFrame(
        [("NO", "geopolitical", ""), ("A", "core", "")],
        "country_code string, group_name string, group_description string"))
    res = {r.country_code: r.resilience_score
           for r in M.mart_resilience_score(prof, gm, ind).collect()}
    assert res["NO"] is None and res["A"] == round(25 + 15 + 117.65 * 0.2, 2)


def test_energy_mix_yoy_previous_present_year_and_zero_prior(spark):
    dd = daily(spark, [
        ("DE", "2022-01-10", "renewable", 50.0, 1.0), ("DE", "2022-01-10", "fossil", 50.0, 1.0),
        ("DE", "2024-01-10", "renewable", 60.0, 1.0), ("DE", "2024-01-10", "fossil", 40.0, 1.0),
        ("DE", "2022-02-10", "renewable", 0.0, 1.0), ("DE", "2022-02-10", "fossil", 10.0, 1.0),
        ("DE", "2023-02-10", "renewable", 5.0, 1.0), ("DE", "2023-02-10", "fossil", 5.0, 1.0),
    ])
    mix = M.mart_energy_mix(dd)
    got = rows(mix, "year", "month_num", "energy_category", "renewable_share_pct",
               "yoy_renewable_growth_pct", order=["month_num", "year", "energy_category"])
    assert got == [
        (2022, 1, "fossil", 50.0, None), (2022, 1, "renewable", 50.0, None),
        (2024, 1, "fossil", 60.0, 20.0), (2024, 1, "renewable", 60.0, 20.0),
        (2022, 2, "fossil", 0.0, None), (2022, 2, "renewable", 0.0, None),
        (2023, 2, "fossil", 50.0, None), (2023, 2, "renewable", 50.0, None),
    ]


def test_event_story_boundary_and_missing_baseline(spark):
    dd = daily(spark, [
        ("EE", "2025-01-31", "renewable", 30.0, None), ("EE", "2025-01-31", "fossil", 70.0, None),
        ("EE", "2025-02-01", "renewable", 40.0, None), ("EE", "2025-02-01", "fossil", 60.0, None),
        ("DE", "2025-01-31", "renewable", 50.0, None), ("DE", "2025-01-31", "fossil", 50.0, None),
    ])
    wx = spark.createDataFrame([("EE", d("2025-01-31"), 20.0, 3.0)],
                               "country_code string, date date, wind_speed_10m_max_kmh double, "
                               "sunshine_duration_hrs double")
    story = M.mart_event_story(dd, wx, focus=["EE"], baseline=["DE"])
    got = rows(story, "date", "brell_period", "renewable_share_pct", "wind_speed_10m_max_kmh",
               "core_avg_renewable_pct", "delta_from_core_baseline", order=["date"])
    assert got == [(d("2025-01-31"), "pre_brell", 30.0, 20.0, 50.0, -20.0),
                   (d("2025-02-01"), "post_brell", 40.0, None, None, None)]


def test_weather_correlation_window_equals_join(spark):
    base = spark.createDataFrame(
        [("DE", d("2024-07-0%d" % i), "summer", float(i), float(2 * i) if i != 3 else None,
          float(i * i), float(i)) for i in range(1, 6)],
        "country_code string, date date, season string, wind_generation_mwh double, "
        "wind_speed_10m_max_kmh double, solar_generation_mwh double, sunshine_duration_hrs double")
    wg = base.withColumns({c: F.lit(None).cast("double") for c in
                           ["renewable_mwh", "total_generation_mwh", "temperature_avg_c",
                            "precipitation_mm", "cloud_cover_pct", "wind_generation_zscore",
                            "solar_generation_zscore"]}).withColumns(
        {"is_wind_anomaly": F.lit(None).cast("boolean"),
         "is_solar_anomaly": F.lit(None).cast("boolean")})
    windowed = M.mart_weather_correlation(wg).select(
        "date", "wind_generation_correlation", "solar_generation_correlation", "observation_count")
    agg = M.seasonal_correlation(wg).first()
    assert agg.observation_count == 5 and agg.wind_generation_correlation == 1.0
    assert all((r.wind_generation_correlation, r.solar_generation_correlation, r.observation_count)
               == (agg.wind_generation_correlation, agg.solar_generation_correlation, 5)
               for r in windowed.collect())


def test_date_gaps_inner_only(spark):
    dd = daily(spark, [("DE", f"2024-01-0{i}", "renewable", 1.0, None) for i in (1, 2, 4, 7)])
    got = rows(Q.date_gaps(dd, ["country_code"], "date"), order=["missing_date"])
    assert got == [("DE", d("2024-01-03")), ("DE", d("2024-01-05")), ("DE", d("2024-01-06"))]


def test_unique_and_accepted_values_let_null_pass(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("z",)], "c string")
    assert rows(Q.unique(df, "c")) == [("a", 2)]
    assert rows(Q.accepted_values(df, "c", ["a"])) == [("z",)]
    assert Q.not_null(df, "c").count() == 2


def test_row_volume_and_ratio_checks(spark):
    dd = daily(spark, [("DE", "2024-01-01", c, 10.0, 5.0)
                       for c in ["renewable", "fossil", "nuclear", "other"]]
               + [("FR", "2024-01-01", "renewable", 10.0, 0.0),
                  ("FR", "2024-01-01", "fossil", 7.0, 5.0)])
    assert rows(Q.min_rows(dd, ["country_code", "date"], 4)) == [("FR", d("2024-01-01"), 2)]
    flagged = Q.ratio_above(dd, "generation_mwh", "load_mwh", 1.5)
    assert sorted(r.country_code for r in flagged.collect()) == ["DE"] * 4  # FR: load 0 / ratio 1.4
    assert {r.generation_to_load_ratio for r in flagged.collect()} == {2.0}


def test_report_severity(spark):
    dd = daily(spark, [("DE", "2024-01-01", "renewable", -1.0, 1.0)])
    rep = Q.report([Q.Check("neg", Q.non_negative(dd, "generation_mwh"), "error"),
                    Q.Check("ratio", Q.ratio_above(dd, "generation_mwh", "load_mwh"), "warn")])
    assert rows(rep, order=["check_name"]) == [("neg", "error", 1, "error"),
                                              ("ratio", "warn", 0, "pass")]


@pytest.mark.parametrize("age_hours,expected", [(12, "pass"), (36, "warn"), (72, "error")])
def test_freshness_levels(spark, age_hours, expected):
    as_of = dt.datetime(2025, 6, 1, 0, 0)
    df = spark.createDataFrame([(as_of - dt.timedelta(hours=age_hours),)], "_loaded_at timestamp")
    out = Q.freshness(df, "_loaded_at", as_of, 1, 2).first()
    assert out.status == expected and out.age_hours == float(age_hours)


def test_preview_and_load_profile(spark):
    from gridmix.operators.aggregates import distinct_values, load_profile, preview
    df = spark.createDataFrame([("DE", 2024), ("FR", 2020), ("DE", 2025)], "c string, y bigint")
    assert preview(df, 2).count() == 2
    assert rows(load_profile(df, "c", "y")) == [(3, 2, 2020, 2025)]
    assert rows(distinct_values(df, "c")) == [("DE",), ("FR",)]


def test_column_checks_one_pass(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "bad")], "k string, c string")
    got = {(r.check_name, r.column_name): r.failures
           for r in Q.column_checks(df, "t", ["k", "c"], {"c": ["x"]}, ["k"]).collect()}
    assert got == {("not_null", "k"): 1, ("not_null", "c"): 1,
                   ("accepted_values", "c"): 1, ("unique", "k"): 1}
