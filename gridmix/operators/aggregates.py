"""Grouped aggregations.

All of these are plain ``groupBy().agg()`` plans: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key is pre-reduced in every
task and never travels as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.constants import CATEGORY_MAP, OTHER_CATEGORY, SEASON_MONTHS, SOLAR_TYPES, WIND_TYPES
from gridmix.functions.calendar import season as season_of, utc_day, year_of
from gridmix.functions.classify import classify
from gridmix.functions.numeric import (
    exact, exact_sum, from_exact, round_half_up, safe_ratio, share_pct,
)


def daily_rollup(
    hourly: DataFrame,
    country: str = "country_code",
    ts: str = "datetime_utc",
    production_type: str = "production_type",
    generation: str = "generation_mwh",
    load: str = "load_mwh",
    category_map: dict | None = None,
    wind_types: list | None = None,
    solar_types: list | None = None,
    seasons: dict | None = None,
) -> DataFrame:
    """Hourly rows -> one row per (country_code, date, energy_category, season).

    Measures: ``generation_mwh`` (sum), ``load_mwh`` (mean of hourly load) and,
    carried for the weather model, ``wind_generation_mwh`` / ``solar_generation_mwh``
    (sums over the wind / solar production types). One shuffle of the large
    input, with map-side partial aggregation; the season depends on the date
    only, so it is derived once per group after the aggregate instead of once
    per hourly row.
    """
    partials = daily_partials(hourly, country, ts, production_type, generation, load,
                              category_map, wind_types, solar_types)
    return rollup_of(partials, seasons)


#: One row of daily partial sums; the measures are whole millionths.
DAY_KEYS = ["country_code", "date", "energy_category"]
PARTIAL_SUMS = ["generation_sum", "load_sum", "load_rows", "wind_sum", "solar_sum"]


def daily_partials(
    hourly: DataFrame,
    country: str = "country_code",
    ts: str = "datetime_utc",
    production_type: str = "production_type",
    generation: str = "generation_mwh",
    load: str = "load_mwh",
    category_map: dict | None = None,
    wind_types: list | None = None,
    solar_types: list | None = None,
) -> DataFrame:
    """Hourly rows -> exact sums per (country_code, date, energy_category).

    Partials of disjoint sets of rows add up (``add_partials``) to those of all
    rows, to the last digit and in any order.
    """
    category_map = category_map if category_map is not None else CATEGORY_MAP
    wind_types = WIND_TYPES if wind_types is None else wind_types
    solar_types = SOLAR_TYPES if solar_types is None else solar_types
    classified = hourly.select(
        F.col(country).alias("country_code"),
        utc_day(ts).alias("date"),
        classify(production_type, category_map, OTHER_CATEGORY).alias("energy_category"),
        F.col(production_type).isin(list(wind_types)).alias("_is_wind"),
        F.col(production_type).isin(list(solar_types)).alias("_is_solar"),
        exact(generation).alias("_gen"),
        exact(load).alias("_load"),
    )
    zero = F.lit(0).cast("bigint")
    return classified.groupBy(*DAY_KEYS).agg(
        F.sum("_gen").alias("generation_sum"),
        F.sum("_load").alias("load_sum"),
        F.count("_load").alias("load_rows"),
        F.sum(F.when(F.col("_is_wind"), F.col("_gen")).otherwise(zero)).alias("wind_sum"),
        F.sum(F.when(F.col("_is_solar"), F.col("_gen")).otherwise(zero)).alias("solar_sum"),
    )


def add_partials(partials: DataFrame) -> DataFrame:
    """Partials of several sets of rows added up: one row per key."""
    return partials.groupBy(*DAY_KEYS).agg(*[F.sum(c).alias(c) for c in PARTIAL_SUMS])


def rollup_of(partials: DataFrame, seasons: dict | None = None) -> DataFrame:
    """Daily rollup (see ``daily_rollup``) of partials with one row per key."""
    return partials.select(
        "country_code", "date", "energy_category",
        season_of("date", seasons or SEASON_MONTHS).alias("season"),
        from_exact("generation_sum").alias("generation_mwh"),
        safe_ratio(from_exact("load_sum"), F.col("load_rows")).alias("load_mwh"),
        from_exact("wind_sum").alias("wind_generation_mwh"),
        from_exact("solar_sum").alias("solar_generation_mwh"))


def conditional_sums(df: DataFrame, keys: list, value: str, conditions: dict) -> DataFrame:
    """Pivot-like sums: one output column per ``{name: condition}`` plus the total."""
    aggs = [exact_sum(value, cond).alias(name) for name, cond in conditions.items()]
    return df.groupBy(*keys).agg(*aggs)


def share_over(df: DataFrame, value: str, cond: Column, coarse_keys: list,
               out: str = "renewable_share_pct", digits: int = 2) -> DataFrame:
    """Add a share whose denominator is a coarser grain than the rows.

    ``round(sum(value where cond) / nullif(sum(value), 0) * 100)`` over
    ``coarse_keys``, repeated on every row of the coarse group. The rows must
    already be aggregated (small); the window shuffles on ``coarse_keys`` only.
    """
    w = Window.partitionBy(*coarse_keys)
    zero = F.lit(0).cast("bigint")
    part = from_exact(F.sum(F.when(cond, exact(value)).otherwise(zero)).over(w))
    total = from_exact(F.sum(exact(value)).over(w))
    return df.withColumn(out, round_half_up(safe_ratio(part, total) * 100, digits))


def count_qualifying_days(df: DataFrame, keys: list, date_col: str, value: str,
                          cond: Column, threshold: float = 80,
                          out: str = "renewable_independence_days") -> DataFrame:
    """Days per (keys, year) whose rounded share is strictly above ``threshold``.

    Stage 1 computes the daily share per (keys, date); stage 2 counts qualifying
    days per (keys, year). Both are partial+final aggregates.
    """
    daily = df.groupBy(*keys, date_col).agg(share_pct(value, cond).alias("_share"))
    return daily.groupBy(*keys, year_of(date_col).alias("year")).agg(
        F.count_if(F.col("_share") > F.lit(threshold)).cast("bigint").alias(out)
    )


def load_profile(df: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """One-row profile of a load: rows, distinct keys, min and max of the order column."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"),
        F.countDistinct(key_col).cast("bigint").alias("distinct_keys"),
        F.min(order_col).alias("min_value"),
        F.max(order_col).alias("max_value"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, unordered (a look at a load, not a top-k)."""
    return df.limit(n)


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Sorted distinct values of one or more columns (preview listing)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct().orderBy(*cols)
