"""Set-like operators: unions, date spines, expected-minus-actual, key grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_frames(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (frames may list columns in any order)."""
    if not dfs:
        raise ValueError("union_frames needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def date_spine(df: DataFrame, keys: list, date_col: str = "date",
               out: str = "expected_date") -> DataFrame:
    """Every calendar day between the first and last date of each key.

    Per key: ``min``/``max`` (partial aggregates), then ``explode(sequence(...))``;
    the spine of a key has one row per day of its own span.
    """
    bounds = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.select(
        *keys,
        F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 DAY"))).alias(out),
    )


def gap_runs(df: DataFrame, keys: list, date_col: str = "date") -> DataFrame:
    """(keys, gap_start, gap_end, days) of every run of missing days between two present ones.

    Each distinct day looks at the next one of its key; a step of more than one
    day is a gap. No calendar is built, so the work grows with the days that are
    there, however far apart the first and last one lie. A key's days are at
    most a calendar's, whatever the number of rows: they are made distinct first.
    """
    days = df.select(*keys, F.col(date_col).alias("_day")).where("_day is not null").distinct()
    following = F.lead("_day").over(Window.partitionBy(*keys).orderBy("_day"))
    steps = days.withColumn("_next", following).where(F.date_diff("_next", "_day") > 1)
    return steps.select(*keys, F.date_add("_day", 1).alias("gap_start"), F.date_sub("_next", 1).alias("gap_end"),
                        (F.date_diff("_next", "_day") - 1).cast("bigint").alias("days"))


def island_runs(df: DataFrame, keys: list, date_col: str = "date") -> DataFrame:
    """(keys, island_start, island_end, days) of every run of consecutive present days.

    A day's number minus its place among its key's days is the same for the days
    of one run and for no others.
    """
    days = df.select(*keys, F.col(date_col).alias("_day")).where("_day is not null").distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    runs = days.withColumn("_run", F.unix_date("_day") - place).groupBy(*keys, "_run")
    return runs.agg(F.min("_day").alias("island_start"), F.max("_day").alias("island_end"),
                    F.count(F.lit(1)).cast("bigint").alias("days")).drop("_run")


def missing_keys(expected: DataFrame, actual: DataFrame, on: list) -> DataFrame:
    """Rows of ``expected`` whose key does not occur in ``actual`` (anti-join)."""
    return expected.join(actual.select(*on), on=on, how="left_anti")


def grid(values: DataFrame, key_col: str, keys: list) -> DataFrame:
    """Every (key, value row) combination for a literal key list.

    The key list is a literal array exploded on each value row, so no join is
    needed; ``values`` should be distinct.
    """
    arr = F.array(*[F.lit(k) for k in keys])
    return values.select(F.explode(arr).alias(key_col), *values.columns)
