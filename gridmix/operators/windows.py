"""Window operators: group averages, ranks, rolling z-scores, year-over-year growth.

Windows here run on already-aggregated rows (one per country-day, country-year
or country-month): their partitions are bounded by the calendar, not by the
volume of raw data, so a key that holds a third of the raw rows still yields a
partition of at most one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.constants import ANOMALY_Z, ROLLING_ROWS
from gridmix.functions.numeric import round_half_up, safe_ratio


def group_avg_delta(df: DataFrame, value: str, keys: list,
                    avg_out: str = "group_avg_renewable_pct",
                    delta_out: str = "delta_from_group_avg", digits: int = 2) -> DataFrame:
    """Partition average of ``value`` and each row's difference from it (both rounded)."""
    w = Window.partitionBy(*keys)
    avg = F.avg(value).over(w)
    return df.withColumns({
        avg_out: round_half_up(avg, digits),
        delta_out: round_half_up(F.col(value) - avg, digits),
    })


def rank_desc(df: DataFrame, value: str, keys: list, out: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value DESC)``, NULLs last, as bigint."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(out, F.rank().over(w).cast("bigint"))


def rolling_zscore(df: DataFrame, value: str, keys: list, order: str, out: str,
                   n: int = ROLLING_ROWS, digits: int = 2) -> DataFrame:
    """Z-score of each row against the trailing ``n`` rows (itself included).

    ``round((x - avg) / nullif(stddev_samp, 0), digits)`` over
    ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``; the first row of a key and
    constant stretches give NULL.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    x = F.col(value)
    return df.withColumn(
        out, round_half_up(safe_ratio(x - F.avg(x).over(w), F.stddev_samp(x).over(w)), digits)
    )


def rolling_stat(df: DataFrame, value: str, keys: list, order: str, out: str,
                 stat: str = "avg", n: int = ROLLING_ROWS, digits: int | None = None) -> DataFrame:
    """Trailing ``n``-row mean (``stat="avg"``) or sample standard deviation
    (``stat="stddev"``) of ``value``, optionally rounded."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    fn = {"avg": F.avg, "stddev": F.stddev_samp}[stat]
    c = fn(value).over(w)
    return df.withColumn(out, c if digits is None else round_half_up(c, digits))


def flag_anomaly(df: DataFrame, z: str, out: str, threshold: float = ANOMALY_Z) -> DataFrame:
    """``abs(z) > threshold`` on the (rounded) z; NULL z gives a NULL flag."""
    return df.withColumn(out, F.abs(F.col(z)) > F.lit(threshold))


def lag_prior(df: DataFrame, value: str, keys: list, order: str, out: str) -> DataFrame:
    """Value of the previous present row (not necessarily order-1) within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(out, F.lag(value).over(w))


def yoy_growth(df: DataFrame, value: str, keys: list, year_col: str = "year",
               out: str = "yoy_renewable_growth_pct", digits: int = 2) -> DataFrame:
    """``round((x - lag(x)) / nullif(lag(x), 0) * 100, digits)`` by year within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(year_col)
    prior = F.lag(value).over(w)
    return df.withColumn(
        out, round_half_up(safe_ratio(F.col(value) - prior, prior) * 100, digits)
    )
