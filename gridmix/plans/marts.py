"""Mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.constants import (
    BALTIC_COUNTRIES, CO2_BASELINE_G_KWH, CO2_DIVISOR, CORE_COUNTRIES, EVENT_DATE, EVENT_LABELS,
    INDEPENDENCE_SHARE, RESILIENCE_WEIGHTS,
)
from gridmix.functions.calendar import month_num_of, month_start, period, year_of
from gridmix.functions.numeric import exact_sum, safe_corr, share_pct
from gridmix.functions.scores import (
    delta, emissions_avoided, resilience, target_gap, target_progress,
)
from gridmix.operators.aggregates import count_qualifying_days, share_over
from gridmix.operators.joins import crosswalk as crosswalk_join, lookup, semi_filter
from gridmix.operators.windows import yoy_growth
from gridmix.plans.intermediate import is_fossil, is_renewable

MONTH_KEYS = ["country_code", "month", "year", "month_num"]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"month": month_start("date"), "year": year_of("date"),
                           "month_num": month_num_of("date")})


def mart_energy_mix(daily: DataFrame) -> DataFrame:
    """M9: monthly generation per category, the country-month renewable share on
    every category row, and its year-over-year growth for the same month."""
    monthly = (_with_month(daily)
               .groupBy(*MONTH_KEYS, "energy_category", "season")
               .agg(exact_sum("generation_mwh").alias("generation_mwh"),
                    exact_sum("load_mwh").alias("load_mwh")))
    shared = share_over(monthly, "generation_mwh", is_renewable(), ["country_code", "month"],
                        out="renewable_share_pct")
    out = yoy_growth(shared, "renewable_share_pct", ["country_code", "month_num", "energy_category"],
                     "year", out="yoy_renewable_growth_pct")
    return out.select("country_code", "month", "year", "month_num", "energy_category", "season",
                      "generation_mwh", "load_mwh", "renewable_share_pct",
                      "yoy_renewable_growth_pct")


def mart_weather_correlation(weather_gen: DataFrame) -> DataFrame:
    """Daily detail with the wind/solar correlations and observation count of
    its (country, season, year) group.

    The group statistics are window aggregates over the detail rows: one shuffle
    on the group keys instead of an aggregate plus a join back.
    """
    detail = weather_gen.withColumns({"year": year_of("date"), "month_num": month_num_of("date")})
    w = Window.partitionBy("country_code", "season", "year")
    return detail.select(
        "country_code", "date", "season", "year", "month_num",
        "wind_speed_10m_max_kmh", "sunshine_duration_hrs", "temperature_avg_c",
        "precipitation_mm", "cloud_cover_pct",
        "wind_generation_mwh", "solar_generation_mwh", "renewable_mwh", "total_generation_mwh",
        "wind_generation_zscore", "solar_generation_zscore", "is_wind_anomaly", "is_solar_anomaly",
        safe_corr("wind_speed_10m_max_kmh", "wind_generation_mwh", window=w)
        .alias("wind_generation_correlation"),
        safe_corr("sunshine_duration_hrs", "solar_generation_mwh", window=w)
        .alias("solar_generation_correlation"),
        F.count(F.lit(1)).over(w).cast("bigint").alias("observation_count"),
    )


def seasonal_correlation(weather_gen: DataFrame) -> DataFrame:
    """Per (country, season, year): wind and solar correlation and row count."""
    return (weather_gen.withColumn("year", year_of("date"))
            .groupBy("country_code", "season", "year")
            .agg(safe_corr("wind_speed_10m_max_kmh", "wind_generation_mwh")
                 .alias("wind_generation_correlation"),
                 safe_corr("sunshine_duration_hrs", "solar_generation_mwh")
                 .alias("solar_generation_correlation"),
                 F.count(F.lit(1)).cast("bigint").alias("observation_count")))


def mart_country_independence(profile: DataFrame, daily: DataFrame, annual: DataFrame,
                              xwalk: DataFrame, threshold: float = INDEPENDENCE_SHARE,
                              baseline: float = CO2_BASELINE_G_KWH,
                              divisor: float = CO2_DIVISOR) -> DataFrame:
    """Days above the share threshold, target progress and gap, CO2 avoided."""
    days = count_qualifying_days(daily, ["country_code"], "date", "generation_mwh",
                                 is_renewable(), threshold)
    stats = annual.select("country_code_iso3", "year", "co2_intensity_gco2_kwh")
    base = profile.select("country_code", "country_name", "year", "renewable_share_pct",
                          "fossil_dependency_score", "total_generation_mwh", "total_load_mwh",
                          "is_eu_member", "eu_target_2030_pct", "latitude", "longitude")
    joined = base.join(days, ["country_code", "year"], "left")
    joined = crosswalk_join(joined, xwalk, "country_code", "country_code_iso3")
    joined = lookup(joined, stats, ["country_code_iso3", "year"])
    return joined.select(
        "country_code", "country_name", "year", "renewable_share_pct", "fossil_dependency_score",
        "total_generation_mwh", "total_load_mwh", "is_eu_member", "eu_target_2030_pct",
        "latitude", "longitude", "renewable_independence_days",
        target_progress("renewable_share_pct", "eu_target_2030_pct")
        .alias("pct_progress_toward_2030_target"),
        target_gap("renewable_share_pct", "eu_target_2030_pct").alias("gap_to_2030_target_pct"),
        emissions_avoided("co2_intensity_gco2_kwh", "total_generation_mwh", baseline, divisor)
        .alias("co2_avoided_tonnes"),
    )


def mart_fossil_dependency(daily: DataFrame, group_metrics: DataFrame) -> DataFrame:
    """Monthly fossil exposure with the group context of the country-year
    (one row per group the country belongs to)."""
    monthly = (_with_month(daily)
               .groupBy(*MONTH_KEYS, "season")
               .agg(exact_sum("generation_mwh").alias("total_generation_mwh"),
                    exact_sum("generation_mwh", is_fossil()).alias("fossil_generation_mwh"),
                    share_pct("generation_mwh", is_fossil()).alias("fossil_dependency_score")))
    ctx = group_metrics.select("country_code", "year", "group_name", "group_avg_renewable_pct",
                               "delta_from_group_avg", "rank_within_group", "rank_overall")
    return monthly.join(ctx, ["country_code", "year"], "left").select(
        "country_code", "month", "year", "month_num", "season", "total_generation_mwh",
        "fossil_generation_mwh", "fossil_dependency_score", "group_name",
        "group_avg_renewable_pct", "delta_from_group_avg", "rank_within_group", "rank_overall")


def mart_resilience_score(profile: DataFrame, group_metrics: DataFrame,
                          independence: DataFrame, weights: tuple = RESILIENCE_WEIGHTS) -> DataFrame:
    """Composite score per country-year (and group)."""
    base = profile.select("country_code", "country_name", "year", "renewable_share_pct",
                          "fossil_dependency_score", "is_eu_member", "eu_target_2030_pct")
    ind = independence.select("country_code", "year", "renewable_independence_days",
                              "pct_progress_toward_2030_target", "gap_to_2030_target_pct",
                              "co2_avoided_tonnes")
    grp = group_metrics.select("country_code", "year", "group_name", "group_avg_renewable_pct",
                               "delta_from_group_avg", "rank_within_group", "rank_overall")
    joined = base.join(ind, ["country_code", "year"], "left").join(grp, ["country_code", "year"],
                                                                     "left")
    return joined.select(
        "country_code", "country_name", "year", "renewable_share_pct", "fossil_dependency_score",
        "is_eu_member", "eu_target_2030_pct", "renewable_independence_days",
        "pct_progress_toward_2030_target", "gap_to_2030_target_pct", "co2_avoided_tonnes",
        "group_name", "group_avg_renewable_pct", "delta_from_group_avg", "rank_within_group",
        "rank_overall",
        resilience("renewable_share_pct", "fossil_dependency_score",
                   "pct_progress_toward_2030_target", weights).alias("resilience_score"),
    )


def _members(df: DataFrame, countries, col: str = "country_code") -> DataFrame:
    if isinstance(countries, DataFrame):
        return semi_filter(df, countries.select(col), col)
    return df.filter(F.col(col).isin(list(countries)))


def baseline_share(daily: DataFrame, baseline=CORE_COUNTRIES) -> DataFrame:
    """Per date: pooled renewable share of the baseline countries (sum/sum)."""
    return (_members(daily, baseline)
            .groupBy("date")
            .agg(share_pct("generation_mwh", is_renewable()).alias("core_avg_renewable_pct")))


def mart_event_story(daily: DataFrame, weather: DataFrame, focus=BALTIC_COUNTRIES,
                     baseline=CORE_COUNTRIES, event_date=EVENT_DATE,
                     labels: tuple = EVENT_LABELS) -> DataFrame:
    """before/after view of the focus countries against the baseline group.

    Focus rows are aggregated per (country, date) before the weather join; the
    baseline is one row per date and joins on date only.
    """
    focus_daily = (_members(daily, focus)
                   .groupBy("country_code", "date", "season")
                   .agg(exact_sum("generation_mwh", is_renewable()).alias("renewable_mwh"),
                        exact_sum("generation_mwh").alias("total_generation_mwh"),
                        share_pct("generation_mwh", is_renewable()).alias("renewable_share_pct")))
    wx = weather.select("country_code", "date", "wind_speed_10m_max_kmh", "sunshine_duration_hrs")
    story = (focus_daily.join(wx, ["country_code", "date"], "left")
             .withColumns({"year": year_of("date"),
                           "brell_period": period("date", event_date, labels)}))
    base = baseline_share(daily, baseline)
    return story.join(base, "date", "left").select(
        "country_code", "date", "season", "year", "brell_period", "renewable_mwh",
        "total_generation_mwh", "renewable_share_pct", "wind_speed_10m_max_kmh",
        "sunshine_duration_hrs", "core_avg_renewable_pct",
        delta("renewable_share_pct", "core_avg_renewable_pct").alias("delta_from_core_baseline"),
    )
