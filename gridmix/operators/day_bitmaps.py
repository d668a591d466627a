"""Qualifying days as bitmaps: one bit per day of the year.

A block holds the days of one month. Blocks of a year are merged by OR and
counted by bits, so the count reads no day again; a day that is loaded twice
sets the same bit, and a month whose days changed has its block replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.functions.calendar import month_start, year_of
from gridmix.functions.numeric import share_pct


def qualifying_blocks(df: DataFrame, keys: list, date_col: str, value: str, cond: Column,
                      threshold: float = 80) -> DataFrame:
    """Per (keys, year, month) the bitmap ``days`` of the days whose rounded share is above ``threshold``."""
    daily = df.groupBy(*keys, date_col).agg(share_pct(value, cond).alias("_share"))
    day = F.when(F.col("_share") > F.lit(threshold), F.dayofyear(date_col))
    return daily.groupBy(*keys, year_of(date_col).alias("year"), month_start(date_col).alias("month")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"))


def count_days(blocks: DataFrame, keys: list, out: str = "renewable_independence_days") -> DataFrame:
    """Qualifying days per (keys, year): the bits of its blocks' OR."""
    return blocks.groupBy(*keys, "year").agg(
        F.bitmap_count(F.bitmap_or_agg("days")).cast("bigint").alias(out))
