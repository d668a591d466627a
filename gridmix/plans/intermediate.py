"""Intermediate models (M4–M8): daily/yearly generation, weather join with
rolling z-scores, country profile and group metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.constants import ANOMALY_Z, ROLLING_ROWS
from gridmix.functions.calendar import year_of
from gridmix.functions.numeric import exact_sum, share_pct
from gridmix.operators.aggregates import daily_rollup, share_over
from gridmix.operators.joins import crosswalk as crosswalk_join, fan_out, lookup
from gridmix.operators.windows import flag_anomaly, group_avg_delta, rank_desc, rolling_zscore

DAILY_COLUMNS = ["country_code", "date", "energy_category", "season", "generation_mwh", "load_mwh"]
WEATHER_COLUMNS = ["wind_speed_10m_max_kmh", "sunshine_duration_hrs", "temperature_avg_c",
                   "precipitation_mm", "cloud_cover_pct"]


def generation_rollup(hourly: DataFrame, **params) -> DataFrame:
    """Daily category rollup with wind/solar sums carried along (see ``daily_rollup``)."""
    return daily_rollup(hourly, **params)


def int_generation_daily(rollup: DataFrame) -> DataFrame:
    """M4: one row per (country_code, date, energy_category, season)."""
    return rollup.select(*DAILY_COLUMNS)


def is_renewable(cat: str = "energy_category"):
    return F.col(cat) == "renewable"


def is_fossil(cat: str = "energy_category"):
    return F.col(cat) == "fossil"


def int_generation_yearly(daily: DataFrame, annual: DataFrame, xwalk: DataFrame) -> DataFrame:
    """M5: yearly generation per category with the country's yearly renewable share
    (denominator over all categories of the country-year) and annual statistics
    joined through the ISO2 -> ISO3 crosswalk."""
    yearly = (daily.withColumn("year", year_of("date"))
              .groupBy("country_code", "year", "energy_category")
              .agg(exact_sum("generation_mwh").alias("generation_mwh"),
                   exact_sum("load_mwh").alias("load_mwh")))
    yearly = share_over(yearly, "generation_mwh", is_renewable(), ["country_code", "year"],
                        out="renewable_share_pct")
    stats = annual.select(
        "country_code_iso3", "year", "solar_generation_twh", "wind_generation_twh",
        "co2_intensity_gco2_kwh", F.col("fossil_share_pct").alias("owid_fossil_share_pct"))
    keyed = crosswalk_join(yearly, xwalk, "country_code", "country_code_iso3")
    return lookup(keyed, stats, ["country_code_iso3", "year"]).select(
        "country_code", "year", "energy_category", "generation_mwh", "load_mwh",
        "renewable_share_pct", "solar_generation_twh", "wind_generation_twh",
        "co2_intensity_gco2_kwh", "owid_fossil_share_pct")


def weather_daily_generation(rollup: DataFrame) -> DataFrame:
    """Per (country_code, date, season): renewable, wind, solar and total MWh."""
    return rollup.groupBy("country_code", "date", "season").agg(
        exact_sum("generation_mwh", is_renewable()).alias("renewable_mwh"),
        exact_sum("wind_generation_mwh").alias("wind_generation_mwh"),
        exact_sum("solar_generation_mwh").alias("solar_generation_mwh"),
        exact_sum("generation_mwh").alias("total_generation_mwh"),
    )


def add_zscores(df: DataFrame, n: int = ROLLING_ROWS, threshold: float = ANOMALY_Z) -> DataFrame:
    """Rolling wind/solar z-scores per country and their anomaly flags.

    Both z-scores share one window specification, so Spark evaluates them in a
    single Window operator after one shuffle and sort on (country_code, date).
    """
    out = rolling_zscore(df, "wind_generation_mwh", ["country_code"], "date",
                         "wind_generation_zscore", n=n)
    out = rolling_zscore(out, "solar_generation_mwh", ["country_code"], "date",
                         "solar_generation_zscore", n=n)
    out = flag_anomaly(out, "wind_generation_zscore", "is_wind_anomaly", threshold)
    return flag_anomaly(out, "solar_generation_zscore", "is_solar_anomaly", threshold)


def int_weather_generation(rollup: DataFrame, weather: DataFrame,
                           n: int = ROLLING_ROWS, threshold: float = ANOMALY_Z) -> DataFrame:
    """M6: daily generation joined to staged weather, with 90-row z-scores and flags."""
    gen = weather_daily_generation(rollup)
    joined = gen.join(weather.select("country_code", "date", *WEATHER_COLUMNS),
                      ["country_code", "date"], "left")
    return add_zscores(joined, n, threshold).select(
        "country_code", "date", "season", "renewable_mwh", "wind_generation_mwh",
        "solar_generation_mwh", "total_generation_mwh", *WEATHER_COLUMNS,
        "wind_generation_zscore", "solar_generation_zscore", "is_wind_anomaly", "is_solar_anomaly")


def country_year_shares(daily: DataFrame) -> DataFrame:
    """Per (country_code, year): renewable share, fossil score, total generation and load.

    ``total_load_mwh`` sums the daily category rows' mean hourly load, so a day
    counts its load once per category present (up to four times), exactly as
    the original model does; no other definition is documented for it.
    """
    return (daily.withColumn("year", year_of("date"))
            .groupBy("country_code", "year")
            .agg(share_pct("generation_mwh", is_renewable()).alias("renewable_share_pct"),
                 share_pct("generation_mwh", is_fossil()).alias("fossil_dependency_score"),
                 exact_sum("generation_mwh").alias("total_generation_mwh"),
                 exact_sum("load_mwh").alias("total_load_mwh")))


def int_country_profile(daily: DataFrame, reference: DataFrame) -> DataFrame:
    """M7: yearly country profile joined to the (broadcast) country reference."""
    agg = country_year_shares(daily)
    ref = reference.select("country_code", "country_name", "capital_city", "latitude",
                           "longitude", "population", "is_eu_member", "brell_member_pre2025",
                           "eu_target_2030_pct")
    return lookup(agg, ref, "country_code").select(
        "country_code", "year", "renewable_share_pct", "fossil_dependency_score",
        "total_generation_mwh", "total_load_mwh", "country_name", "capital_city", "latitude",
        "longitude", "population", "is_eu_member", "brell_member_pre2025", "eu_target_2030_pct")


def int_country_group_metrics(profile: DataFrame, groups: DataFrame) -> DataFrame:
    """M8: group averages, deltas and ranks.

    ``rank_overall`` is ranked on the profile (one row per country-year) before
    the many-to-many group join, so a country in two groups counts once.
    """
    base = profile.select("country_code", "country_name", "year", "renewable_share_pct",
                          "fossil_dependency_score", "total_generation_mwh", "is_eu_member",
                          "eu_target_2030_pct")
    ranked = rank_desc(base, "renewable_share_pct", ["year"], "rank_overall")
    joined = fan_out(ranked, groups.select("country_code", "group_name", "group_description"),
                     "country_code")
    out = group_avg_delta(joined, "renewable_share_pct", ["group_name", "year"])
    out = rank_desc(out, "renewable_share_pct", ["group_name", "year"], "rank_within_group")
    return out.select(
        "country_code", "country_name", "year", "renewable_share_pct", "fossil_dependency_score",
        "total_generation_mwh", "is_eu_member", "eu_target_2030_pct", "group_name",
        "group_description", "group_avg_renewable_pct", "delta_from_group_avg",
        "rank_within_group", "rank_overall")
