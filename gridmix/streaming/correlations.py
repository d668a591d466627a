"""Seasonal weather correlations kept as a table of co-moments, updated by month.

A block holds the co-moments of one country's days of one month (a month lies in
one season). When days change, only their months are read from the daily
weather table and only their blocks are replaced, so an update costs the months
it touches, may be repeated, and takes late days like others. The correlations
of a (country, season, year) are merged from its three blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.functions.calendar import month_start, year_of
from gridmix.operators.comoments import correlation, merge_states, state
from gridmix.sources.sinks import write_table
from gridmix.streaming.incremental import table_exists, upsert

KEYS = ["country_code", "season", "year"]
#: State column -> (weather column, generation column).
PAIRS = {"wind": ("wind_speed_10m_max_kmh", "wind_generation_mwh"),
         "solar": ("sunshine_duration_hrs", "solar_generation_mwh")}


def month_blocks(weather_gen: DataFrame) -> DataFrame:
    """Co-moments and number of rows per (country, season, year, month)."""
    dated = weather_gen.withColumns({"year": year_of("date"), "month": month_start("date")})
    return dated.groupBy(*KEYS, "month").agg(
        *[state(x, y).alias(name) for name, (x, y) in PAIRS.items()],
        F.count(F.lit(1)).cast("bigint").alias("observation_count"))


def refresh_blocks(spark: SparkSession, weather_gen: DataFrame, path: str, days: list | None = None) -> None:
    """Bring the blocks at ``path`` up to date with the months of ``days`` (all months when None).

    ``days`` are the days whose rows changed since the last call; their months are
    read as literal bounds on ``date``, which prune the daily table.
    """
    if days is None or not table_exists(spark, path):
        write_table(month_blocks(weather_gen), path, partition_by="month")
        return
    months = sorted({day.replace(day=1) for day in days})
    if not months:
        return
    within = F.col("date").between(F.lit(months[0]), F.last_day(F.lit(months[-1])))
    touched = weather_gen.filter(within & month_start("date").isin(months))
    upsert(spark, month_blocks(touched), path, [*KEYS, "month"], "month")


def seasonal_correlation(blocks: DataFrame) -> DataFrame:
    """Per (country, season, year): wind and solar correlation and row count, merged from blocks."""
    merged = merge_states(blocks, KEYS, "month", list(PAIRS), ["observation_count"])
    return merged.select(*KEYS, *[correlation(F.col(name)).alias(f"{name}_generation_correlation") for name in PAIRS],
                         "observation_count")
