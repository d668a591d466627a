"""Incremental refresh of the two daily tables (late data within a lookback).

The warehouse being rebuilt reprocesses the last ``LOOKBACK_DAYS`` days on each
run and merges the result on the table's unique key. Here that is:

1. ``lookback_cutoff`` — ``max(date)`` of the target minus N days (one scalar);
2. a filter on the raw timestamp with that literal, so the Parquet scan prunes;
3. re-aggregation of the slice;
4. ``upsert`` — target rows of the touched date partitions whose key is not in
   the slice are kept, slice rows replace or add, and only those partitions
   are overwritten (dynamic partition overwrite). The merged slice is first
   written to the shared checkpoint folder so the job never reads and
   overwrites the same files in one step, and removed from there afterwards.

Rows that come later than the lookback are found by their load time instead
(``refresh_changed``): only the (country, day) pairs they touch, and the z-scores
these reach, are computed and written again.

For the weather table (rolling 90-row z-scores) the last 89 stored rows per
country before the cutoff are read back as window context, so an incremental
run gives the same z-scores as a full rebuild.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmix.constants import LOOKBACK_DAYS, ROLLING_ROWS
from gridmix.functions.calendar import month_start, utc_day
from gridmix.operators.joins import matching
from gridmix.operators.quality import ObservedChecks
from gridmix.plans import intermediate
from gridmix.sources.sinks import Staging, write_table, write_touched


#: Columns of the stored daily weather table.
WEATHER_TABLE = [
    "country_code", "date", "season", "renewable_mwh", "wind_generation_mwh",
    "solar_generation_mwh", "total_generation_mwh", *intermediate.WEATHER_COLUMNS,
    "wind_generation_zscore", "solar_generation_zscore", "is_wind_anomaly", "is_solar_anomaly"]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet table (lists files, reads no rows).

    Only a missing path counts as no table. A table that is there and can't be
    read raises: taking it for a missing one would overwrite its history.
    """
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def max_date(df: DataFrame, date_col: str = "date"):
    """Global ``MAX(date_col)`` as a Python value (one scalar to the driver)."""
    return df.agg(F.max(date_col)).first()[0]


def lookback_cutoff(spark: SparkSession, path: str, date_col: str = "date",
                    days: int = LOOKBACK_DAYS) -> _dt.date | None:
    """``MAX(date) - days`` of the target table, or None when it does not exist yet."""
    if not table_exists(spark, path):
        return None
    newest = max_date(spark.read.parquet(path).select(date_col), date_col)
    return None if newest is None else newest - _dt.timedelta(days=days)


def since(df: DataFrame, ts_col: str, cutoff: _dt.date | None, is_timestamp: bool = True,
          partition_col: str | None = None) -> DataFrame:
    """Rows on or after ``cutoff`` (all rows when cutoff is None).

    The predicate is a literal comparison on the stored column so that Parquet
    row-group statistics prune the scan; when the raw table is partitioned by a
    date column, ``partition_col`` adds the same bound on it so whole partitions
    are skipped before any file is opened.
    """
    if cutoff is None:
        return df
    if partition_col is not None:
        df = df.filter(F.col(partition_col) >= F.lit(cutoff))
    if is_timestamp:
        # A text literal cast to the column's own type: midnight of the cutoff day
        # in the session time zone (or zone-free for timestamp_ntz), independent
        # of the Python process's local zone.
        bound = F.lit(f"{cutoff.isoformat()} 00:00:00").cast(df.schema[ts_col].dataType)
        return df.filter(F.col(ts_col) >= bound)
    return df.filter(F.col(ts_col) >= F.lit(cutoff))


def merge_on_keys(target: DataFrame, updates: DataFrame, keys: list) -> DataFrame:
    """Logical upsert: target rows without a matching key, plus all update rows."""
    kept = matching(target, updates, keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def checks_path(path: str) -> str:
    """Where the failure counts of the table at ``path`` are kept."""
    return f"{path.rstrip('/')}_checks"


def keep_counts(spark: SparkSession, counts: DataFrame, path: str, day: str | None = None,
                touched: list | None = None) -> None:
    """Store check counts beside the table at ``path``: all of them, or those of the ``touched`` days
    in place of what was there. One row per day and check, so bounded by the calendar."""
    where = checks_path(path)
    if touched is None or not table_exists(spark, where):
        write_table(counts, where)
        return
    with Staging(spark) as staging:
        kept = spark.read.parquet(where).filter(~F.col(day).isin(touched) | F.col(day).isNull())
        write_table(staging.put(kept.unionByName(counts)), where)


def upsert(spark: SparkSession, updates: DataFrame, path: str, keys: list,
           partition_col: str = "date", checks: ObservedChecks | None = None) -> None:
    """Merge ``updates`` into the Parquet table at ``path``, partitioned by ``partition_col``.

    Keys absent from ``updates`` are never deleted. Only partitions that
    contain update rows are rewritten. The same call again changes nothing, so a
    run that was ended between two partitions is mended by running it again.
    ``checks`` are counted by partition, from the rows that are rewritten alone
    (a first build counts the table it wrote), and kept beside the table.
    """
    if not table_exists(spark, path):
        write_table(updates, path, partition_by=partition_col)
        if checks is not None:
            keep_counts(spark, checks.by_day(spark.read.parquet(path), partition_col), path)
        return
    with Staging(spark) as staging:
        staged_updates = staging.put(updates)
        # The touched partition values: one per day of the slice, bounded by the
        # calendar (a few days per run, a few thousand for a multi-year backfill).
        # As a literal IN-list they prune the target's partitions statically, so
        # only the touched date folders are listed and read.
        touched = [r[0] for r in staged_updates.select(partition_col).distinct().collect()]
        if not touched:
            return
        target = spark.read.parquet(path)
        target_slice = target.filter(F.col(partition_col).isin(touched))
        merged = staging.put(merge_on_keys(target_slice, staged_updates, keys))
        write_touched(merged.select(*target.columns), path, partition_col)
        if checks is not None:
            if not table_exists(spark, checks_path(path)):
                merged, touched = spark.read.parquet(path), None
            keep_counts(spark, checks.by_day(merged, partition_col), path, partition_col, touched)


# ------------------------------------------------------------ daily tables ----

def refresh_generation_daily(spark: SparkSession, hourly: DataFrame, path: str,
                             lookback_days: int = LOOKBACK_DAYS, raw_partition_col: str | None = None,
                             **rollup_params) -> _dt.date | None:
    """Build or incrementally refresh ``int_generation_daily`` at ``path``.

    Returns the cutoff used (None for a full build).
    """
    cutoff = lookback_cutoff(spark, path, "date", lookback_days)
    rollup = intermediate.generation_rollup(
        since(hourly, "datetime_utc", cutoff, partition_col=raw_partition_col), **rollup_params)
    _put_generation(spark, rollup, path)
    return cutoff


def refresh_weather_generation(spark: SparkSession, hourly: DataFrame, weather: DataFrame,
                               path: str, lookback_days: int = LOOKBACK_DAYS,
                               n: int = ROLLING_ROWS, raw_partition_col: str | None = None,
                               **rollup_params) -> _dt.date | None:
    """Build or incrementally refresh ``int_weather_generation`` at ``path``.

    The slice on/after the cutoff is recomputed from hourly rows; the ``n-1``
    stored rows per country before the cutoff join the window as context, so
    z-scores equal those of a full rebuild.
    """
    cutoff = lookback_cutoff(spark, path, "date", lookback_days)
    rollup = intermediate.generation_rollup(
        since(hourly, "datetime_utc", cutoff, partition_col=raw_partition_col), **rollup_params)
    _put_weather(spark, rollup, weather, path, cutoff, n)
    return cutoff


def refresh_daily(spark: SparkSession, hourly: DataFrame, weather: DataFrame, generation_path: str,
                  weather_path: str, lookback_days: int = LOOKBACK_DAYS, n: int = ROLLING_ROWS,
                  raw_partition_col: str | None = None, checks: dict[str, ObservedChecks] | None = None,
                  **rollup_params) -> _dt.date | None:
    """Build or refresh both daily tables from one scan of the hourly rows.

    The rollup of the slice is written once to the shared folder and both
    tables are put from it. The slice starts at the earlier cutoff of the two
    tables, which is returned; it is everything if one of them doesn't exist yet.
    ``checks`` (by table: ``generation``, ``weather``) are counted with the writes.
    """
    checks = checks or {}
    cutoffs = [lookback_cutoff(spark, p, "date", lookback_days)
               for p in (generation_path, weather_path)]
    cutoff = None if None in cutoffs else min(cutoffs)
    with Staging(spark) as staging:
        rollup = staging.put(intermediate.generation_rollup(
            since(hourly, "datetime_utc", cutoff, partition_col=raw_partition_col), **rollup_params))
        _put_generation(spark, since(rollup, "date", cutoffs[0], is_timestamp=False), generation_path,
                        checks.get("generation"))
        _put_weather(spark, since(rollup, "date", cutoffs[1], is_timestamp=False), weather,
                     weather_path, cutoffs[1], n, checks.get("weather"))
    return cutoff


def newest_load(hourly: DataFrame, loaded_col: str = "_loaded_at"):
    """Load time of the newest raw row: the mark for the next ``refresh_changed``."""
    return max_date(hourly, loaded_col)


def changed_days(hourly: DataFrame, mark, ts_col: str = "datetime_utc",
                 loaded_col: str = "_loaded_at") -> DataFrame:
    """Distinct (country_code, date) that raw rows loaded after ``mark`` belong to."""
    loaded = hourly.filter(F.col(loaded_col) > F.lit(mark))
    return loaded.select("country_code", utc_day(ts_col).alias("date")).distinct()


def refresh_changed(spark: SparkSession, hourly: DataFrame, weather: DataFrame, generation_path: str,
                    weather_path: str, mark, n: int = ROLLING_ROWS, partition_col: str = "date",
                    raw_partition_col: str | None = None, **rollup_params) -> _dt.datetime | None:
    """Refresh both daily tables for rows loaded after ``mark``, however old their days are.

    The change set is the (country, day) pairs those rows touch. They are rolled
    up again from all their raw rows and replace what is stored; the z-scores of
    the ``n - 1`` stored rows of the country after each of them are computed
    again. Only partitions that hold such a row are rewritten, and the result
    equals a full rebuild. Running it again with the same mark changes nothing.
    Returns the mark for the next run (the newest load time); rows without a
    load time are no changes and rows without a time belong to no day; both come in
    with a full build alone.
    """
    newest = newest_load(hourly)
    with Staging(spark) as staging:
        changed = staging.put(changed_days(hourly, mark))
        days = touched_days(changed)
        if days:
            slice_ = since(hourly, "datetime_utc", min(days))
            if raw_partition_col is not None:
                slice_ = slice_.filter(F.col(raw_partition_col).isin(days))
            # Literal days first, which prune the scan; then the exact pairs.
            day = utc_day("datetime_utc")
            slice_ = matching(slice_.filter(day.isin(days)).withColumn("date", day), changed, ["country_code", "date"])
            rollup = staging.put(intermediate.generation_rollup(slice_, **rollup_params))
            put_changed(spark, staging, rollup, weather, generation_path, weather_path, n, partition_col)
    return newest


def touched_days(changed: DataFrame) -> list[_dt.date]:
    """The days of a change set, ordered (bounded by the calendar)."""
    return sorted(r[0] for r in changed.select("date").where("date is not null").distinct().collect())


def put_changed(spark: SparkSession, staging: Staging, rollup: DataFrame, weather: DataFrame,
                generation_path: str, weather_path: str, n: int = ROLLING_ROWS,
                partition_col: str = "date") -> None:
    """Put the whole rollup of some (country, day) pairs into both daily tables.

    ``rollup`` holds all categories of each pair and is stored (staged) already.
    """
    daily = _with_partition(intermediate.int_generation_daily(rollup), partition_col)
    upsert(spark, daily, generation_path, ["country_code", "date", "energy_category"], partition_col)
    fresh = intermediate.weather_daily_generation(rollup)
    wx = weather.select("country_code", "date", *intermediate.WEATHER_COLUMNS)
    fresh = staging.put(fresh.join(wx, ["country_code", "date"], "left"))
    series = fresh.withColumn("_new", F.lit(True))
    days = touched_days(fresh)
    if not days:
        return
    if table_exists(spark, weather_path):
        stored = spark.read.parquet(weather_path).select(*fresh.columns)
        countries = fresh.select("country_code").distinct()
        context = rows_before(stored, countries, days[0], n - 1)
        later = matching(matching(stored.filter(F.col("date") >= F.lit(days[0])), countries, ["country_code"]),
                         fresh, ["country_code", "date"], "left_anti")
        series = series.unionByName(context.unionByName(later).withColumn("_new", F.lit(False)))
    # A row's z-score changes where one of the n rows up to it is new.
    reach = Window.partitionBy("country_code").orderBy("date").rowsBetween(-(n - 1), 0)
    scored = intermediate.add_zscores(series.withColumn("_reached", F.max("_new").over(reach)), n)
    out = _with_partition(scored.filter("_reached").select(*WEATHER_TABLE), partition_col)
    upsert(spark, out, weather_path, ["country_code", "date"], partition_col)


def _with_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """Add the month as a partition column where the table is partitioned by months."""
    return df.withColumn("month", month_start("date")) if partition_col == "month" else df


def _put_generation(spark: SparkSession, rollup: DataFrame, path: str,
                    checks: ObservedChecks | None = None) -> None:
    upsert(spark, intermediate.int_generation_daily(rollup), path,
           ["country_code", "date", "energy_category"], checks=checks)


def _put_weather(spark: SparkSession, rollup: DataFrame, weather: DataFrame, path: str,
                 cutoff: _dt.date | None, n: int, checks: ObservedChecks | None = None) -> None:
    fresh = intermediate.weather_daily_generation(rollup)
    wx = weather.select("country_code", "date", *intermediate.WEATHER_COLUMNS)
    fresh = fresh.join(wx, ["country_code", "date"], "left")
    with Staging(spark) as staging:
        if cutoff is not None:
            fresh = staging.put(fresh)
            context = rows_before(spark.read.parquet(path), fresh.select("country_code"), cutoff, n - 1)
            fresh = context.select(*fresh.columns).withColumn("_ctx", F.lit(True)).unionByName(
                fresh.withColumn("_ctx", F.lit(False)))
        else:
            fresh = fresh.withColumn("_ctx", F.lit(False))
        scored = intermediate.add_zscores(fresh, n).filter(~F.col("_ctx"))
        upsert(spark, scored.select(*WEATHER_TABLE), path, ["country_code", "date"], checks=checks)


def rows_before(stored: DataFrame, keys: DataFrame, cutoff: _dt.date, rows: int,
                key: str = "country_code") -> DataFrame:
    """The last ``rows`` stored rows before ``cutoff`` of each key that ``keys`` holds.

    First only the date partitions of the last ``2 * rows`` days are read. The
    older history is read for the keys alone that have fewer rows there, and not
    at all if there is none.
    """
    latest = Window.partitionBy(key).orderBy(F.col("date").desc())

    def last(df: DataFrame) -> DataFrame:
        # Rank-limit filters are planned as a per-group limit before the shuffle.
        return df.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= rows).drop("_rn")

    wanted = keys.distinct()
    start = cutoff - _dt.timedelta(days=2 * rows)
    before = stored.filter(F.col("date") < F.lit(cutoff))
    near = before.filter(F.col("date") >= F.lit(start))
    held = near.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    short = matching(wanted, held.filter(F.col("_n") >= rows), [key], "left_anti")
    out = last(matching(near, wanted, [key]))
    if short.isEmpty():
        return out
    return matching(out, short, [key], "left_anti").unionByName(last(matching(before, short, [key])))
