"""Operator-level registered queries, each over the whole stand-in tables."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.constants import OWID_COLUMNS, WEATHER_FIELDS
from gridmix.functions.calendar import date_parts, period, season, utc_day, year_of
from gridmix.functions.classify import classify
from gridmix.functions.numeric import masked_avg, round_half_up, safe_ratio
from gridmix.operators import aggregates as A
from gridmix.operators import quality as Q
from gridmix.operators import sets as S
from gridmix.operators import windows as W
from gridmix.operators.day_bitmaps import count_days, qualifying_blocks
from gridmix.operators.distributed import day_blocks, rank_desc_ranges, rolling_zscore_blocks
from gridmix.operators.joins import (
    fan_out, join_detail_to_aggregate, semi_filter,
)
from gridmix.plans import intermediate as I
from gridmix.plans import marts as M
from gridmix.plans import oracle_sql as O
from gridmix.plans.catalog import Models
from gridmix.plans.oracle_sql import ES, MONTH, R, YEAR, with_ctes
from gridmix.plans.registry import register
from gridmix.sources import standins
from gridmix.session import ensure_checkpoint_dir
from gridmix.sources.readers import (
    project_available, read_owid, read_weather_json, recent_days, scope_filter, zip_arrays_to_rows,
)
from gridmix.sources.sinks import Staging, write_csv, write_table
from gridmix.streaming.correlations import refresh_blocks, seasonal_correlation as merged_correlation
from gridmix.streaming.incremental import (
    WEATHER_TABLE, lookback_cutoff, max_date, merge_on_keys, newest_load, put_changed, refresh_changed, since,
    touched_days, upsert,
)
from gridmix.streaming.stream import refresh_stream

# FIXED VALUES of the stand-in scope: the countries and years kept by the scope
# filter (nation keys 0-10 stand for the 11 countries, 1995-2000 for the 6 years),
# the development-sample anchor and the lookback used by the operator queries.
SCOPE_COUNTRIES = [f"NATION_{i}" for i in range(11)]
SCOPE_YEARS = (1995, 2000)
# Keys 25 and 26 have no rows: the coverage check has something to find.
REQUIRED_ISO = [str(i) for i in range(27)]
DEV_AS_OF = "1998-12-31"
DEV_DAYS = 30
LOOKBACK = 3
GROUP_NAMES = ["africa", "america", "asia", "europe", "middle east"]


def _in(items) -> str:
    return "(" + ", ".join(f"'{i}'" for i in items) + ")"


# ------------------------------------------------------------ scans (S*) ----

@register("scan_lineitem_hourly", with_ctes("SELECT * FROM hourly", "hourly"))
def _scan(m: Models) -> DataFrame:
    """Raw hourly generation (declared columns, joins resolved)."""
    return m.hourly


@register("project_available", with_ctes("SELECT * FROM annual_raw", "annual_raw"))
def _project_available(m: Models) -> DataFrame:
    """Keep the wanted raw columns that exist (one wanted column is absent)."""
    df, missing = project_available(m.annual_raw, OWID_COLUMNS + ["not_in_source"])
    assert missing == ["not_in_source"]
    return df


@register("scope_filter", with_ctes(
    f"SELECT * FROM annual_raw WHERE country IN {_in(SCOPE_COUNTRIES)} "
    f"AND year BETWEEN {SCOPE_YEARS[0]} AND {SCOPE_YEARS[1]}", "annual_raw"))
def _scope_filter(m: Models) -> DataFrame:
    """Countries in scope and a year range."""
    return scope_filter(m.annual_raw, "country", SCOPE_COUNTRIES, "year", *SCOPE_YEARS)


@register("recent_days_filter", with_ctes(
    f"SELECT * FROM daily WHERE date >= DATE '{DEV_AS_OF}' - INTERVAL {DEV_DAYS} DAY", "daily"))
def _recent_days(m: Models) -> DataFrame:
    """Development sample of the last N days before an anchor date."""
    return recent_days(m.daily, "date", DEV_DAYS, as_of=DEV_AS_OF)


# FIXED VALUES: the measures of a line item laid out as parallel arrays.
ZIP_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# One document per line item holding parallel arrays (measure names, values,
# positions), zipped back to one row per array position. Row-local: no shuffle
# and no grouping, whatever the key distribution.
@register("zip_arrays_to_rows", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS measure, CAST({m} AS DOUBLE) AS value, "
    f"{i + 1} AS position FROM lineitem" for i, m in enumerate(ZIP_MEASURES)))
def _zip_arrays(m: Models) -> DataFrame:
    """Documents of parallel arrays -> one row per array position."""
    li = standins.table(m.spark, m.sf_dir, "lineitem")
    docs = li.select("l_orderkey", "l_linenumber", F.struct(
        F.array(*[F.lit(c) for c in ZIP_MEASURES]).alias("measure"),
        F.array(*[F.col(c).cast("double") for c in ZIP_MEASURES]).alias("value"),
        F.sequence(F.lit(1), F.lit(len(ZIP_MEASURES))).alias("position")).alias("doc"))
    return zip_arrays_to_rows(docs, "doc", ["value", "position"], time_field="measure",
                              out_time="measure", keep=["l_orderkey", "l_linenumber"])


def _newest_day(hourly: DataFrame) -> _dt.date:
    return max_date(hourly.select(utc_day("datetime_utc").alias("date")))


def _incremental_slice(m: Models, cutoff) -> DataFrame:
    rollup = I.generation_rollup(since(m.hourly, "datetime_utc", cutoff),
                                 category_map=standins.STANDIN_CATEGORY_MAP,
                                 wind_types=standins.STANDIN_WIND_TYPES,
                                 solar_types=standins.STANDIN_SOLAR_TYPES)
    return I.int_generation_daily(rollup)


@register("incremental_lookback", with_ctes(
    f"SELECT * FROM daily WHERE date >= (SELECT max(date) FROM daily) - INTERVAL {LOOKBACK} DAY",
    "daily"))
def _incremental_lookback(m: Models) -> DataFrame:
    """Re-aggregate only the hourly rows of the last N days before MAX(date).

    The newest day is that of the newest hourly row, one column of the scan."""
    cutoff = _newest_day(m.hourly) - _dt.timedelta(days=LOOKBACK)
    return _incremental_slice(m, cutoff)


@register("incremental_upsert", O.model("daily"))
def _incremental_upsert(m: Models) -> DataFrame:
    """An older target (data up to 10 days before the end) merged with the
    lookback slice of the current data equals the full rebuild."""
    newest = _newest_day(m.hourly)
    older_than = (newest - _dt.timedelta(days=10)).isoformat()
    older = m.hourly.filter(F.col("datetime_utc") < F.lit(f"{older_than} 00:00:00")
                            .cast(m.hourly.schema["datetime_utc"].dataType))
    target = I.int_generation_daily(I.generation_rollup(
        older, category_map=standins.STANDIN_CATEGORY_MAP,
        wind_types=standins.STANDIN_WIND_TYPES, solar_types=standins.STANDIN_SOLAR_TYPES))
    cutoff = _newest_day(older) - _dt.timedelta(days=LOOKBACK)
    return merge_on_keys(target, _incremental_slice(m, cutoff),
                         ["country_code", "date", "energy_category"])


# ------------------------------------------------- projections / filters ----

STANDIN_ROLLUP = {"category_map": standins.STANDIN_CATEGORY_MAP, "wind_types": standins.STANDIN_WIND_TYPES,
                  "solar_types": standins.STANDIN_SOLAR_TYPES}


def _scratch(m: Models, name: str) -> str:
    """A new folder of the shared checkpoint folder for the tables of one query."""
    return f"{ensure_checkpoint_dir(m.spark).rstrip('/')}/gridmix-{name}-{uuid.uuid4().hex}"


@register("upsert_on_disk", O.model("daily"))
def _upsert_on_disk(m: Models) -> DataFrame:
    """A stored date-partitioned table (months here) that lacks the last 45 days and has wrong
    figures in its own last days is refreshed from the lookback slice of the current data."""
    path, keys = _scratch(m, "upsert"), ["country_code", "date", "energy_category"]
    cut = _newest_day(m.hourly) - _dt.timedelta(days=45)
    daily = I.int_generation_daily(I.generation_rollup(m.hourly, **STANDIN_ROLLUP))
    daily = daily.withColumn("month", F.trunc("date", "MM"))
    wrong = F.when(F.col("date") >= F.lit(cut - _dt.timedelta(days=LOOKBACK)), -1.0).otherwise(F.col("generation_mwh"))
    upsert(m.spark, daily.filter(F.col("date") < F.lit(cut)).withColumn("generation_mwh", wrong), path, keys, "month")
    cutoff = lookback_cutoff(m.spark, path, days=LOOKBACK)
    upsert(m.spark, _incremental_slice(m, cutoff).withColumn("month", F.trunc("date", "MM")), path, keys, "month")
    return m.spark.read.parquet(path).select(*I.DAILY_COLUMNS)


@register("full_replace_partitioned", with_ctes(
    "SELECT * FROM daily WHERE date >= (SELECT max(date) FROM daily) - INTERVAL 400 DAY", "daily"))
def _full_replace(m: Models) -> DataFrame:
    """A partitioned table of all months is replaced by one of the last 400 days; the other
    months' partitions are gone, whatever the session's overwrite mode."""
    path = _scratch(m, "replace")
    dated = m.daily.withColumn("month", F.trunc("date", "MM"))
    write_table(dated, path, partition_by="month")
    newest = max_date(m.spark.read.parquet(path))
    write_table(dated.filter(F.col("date") >= F.lit(newest - _dt.timedelta(days=400))), path, partition_by="month")
    return m.spark.read.parquet(path).select(*I.DAILY_COLUMNS)


@register("csv_by_header", with_ctes("SELECT * FROM annual_raw", "annual_raw"))
def _csv_by_header(m: Models) -> DataFrame:
    """Yearly statistics written as CSV, the odd years with their columns in reverse order,
    and read back by name."""
    path = _scratch(m, "csv")
    odd = F.col("year") % 2 == 1
    write_csv(m.annual_raw.filter(~odd), f"{path}/even")
    write_csv(m.annual_raw.filter(odd).select(*reversed(m.annual_raw.columns)), f"{path}/odd")
    return read_owid(m.spark, [f"{path}/even", f"{path}/odd"])[0]


@register("json_documents", with_ctes("SELECT * FROM weather_raw", "weather_raw"))
def _json_documents(m: Models) -> DataFrame:
    """One JSON document of parallel daily arrays per country and year, written and read back."""
    path = _scratch(m, "json")
    ordered = F.array_sort(F.collect_list(F.struct("date", *WEATHER_FIELDS)))
    # A document holds the days of a calendar year at most.
    docs = m.weather_raw.groupBy("country_code", F.year("date").alias("year")).agg(ordered.alias("r"))
    daily = F.struct(F.transform("r", lambda d: d["date"].cast("string")).alias("time"),
                     *[F.col(f"r.{c}").alias(c) for c in WEATHER_FIELDS])
    docs.select(daily.alias("daily"), F.concat_ws("-", "country_code", "year").alias("doc")).write.partitionBy("doc").json(path)
    back = read_weather_json(m.spark, path, country_pattern=r"doc=(.*)-\d+/[^/]*$", of_path=True)
    return back.withColumn("date", F.col("date").cast("date"))


@register("stream_generation_daily", O.model("daily"))
def _stream_daily(m: Models) -> DataFrame:
    """The hourly rows landed as files and read as a stream, a few files a batch; every batch
    adds to the ledger and rewrites the months it touches."""
    return m.spark.read.parquet(_streamed(m)[0]).select(*I.DAILY_COLUMNS)


@register("stream_weather_generation", O.model("weather_generation"))
def _stream_weather(m: Models) -> DataFrame:
    """The weather table after the same stream: z-scores are scored again where a batch reaches them."""
    return m.spark.read.parquet(_streamed(m)[1]).select(*WEATHER_TABLE)


def _streamed(m: Models) -> tuple[str, str]:
    """Paths of both daily tables after a stream over the landed hourly rows in three batches."""
    root = _scratch(m, "stream")
    rows = m.hourly.withColumn("_loaded_at", F.col("datetime_utc").cast("timestamp"))
    # Rows go to files by hash, so each batch holds days of all years: most are late.
    rows = rows.withColumn("datetime_utc", F.col("datetime_utc").cast("timestamp"))
    rows.repartition(6, F.xxhash64(*rows.columns)).write.parquet(f"{root}/landing")
    # Weather is a table of its own here; written once, it isn't derived again in each batch.
    m.weather.write.parquet(f"{root}/weather")
    refresh_stream(m.spark, f"{root}/landing", m.spark.read.parquet(f"{root}/weather"), f"{root}/daily", f"{root}/wg",
                   f"{root}/ledger", f"{root}/checkpoint", files_per_batch=2, partition_col="month",
                   compact_every=2, **STANDIN_ROLLUP)
    return f"{root}/daily", f"{root}/wg"


@register("late_rows_change_set", O.model("weather_generation"))
def _late_rows(m: Models) -> DataFrame:
    """Tables built without a tenth of the hourly rows, which then come in late, with days
    of all ages; only what they touch is computed again. The result is that of all rows."""
    root, spark = _scratch(m, "late"), m.spark
    late = F.pmod(F.xxhash64(*m.hourly.columns), F.lit(10)) == 0
    loaded = F.timestamp_seconds(F.when(late, F.lit(2_000_000_000)).otherwise(F.lit(1_000_000_000)))
    m.hourly.withColumn("_loaded_at", loaded).write.parquet(f"{root}/hourly")
    m.weather.write.parquet(f"{root}/weather")
    hourly, weather = spark.read.parquet(f"{root}/hourly"), spark.read.parquet(f"{root}/weather")
    early = hourly.filter(F.col("_loaded_at") < F.timestamp_seconds(F.lit(1_500_000_000)))
    with Staging(spark) as staging:
        first = staging.put(I.generation_rollup(early, **STANDIN_ROLLUP))
        put_changed(spark, staging, first, weather, f"{root}/daily", f"{root}/wg", partition_col="month")
    refresh_changed(spark, hourly, weather, f"{root}/daily", f"{root}/wg", newest_load(early),
                    partition_col="month", **STANDIN_ROLLUP)
    return spark.read.parquet(f"{root}/wg").select(*WEATHER_TABLE)


@register("stage_rename_cast", O.model("annual"))
def _stage_rename_cast(m: Models) -> DataFrame:
    """Rename + cast to the declared schema."""
    return m.annual


@register("filter_non_null_keys", with_ctes(
    "SELECT country_code, date, wind_generation_zscore FROM weather_generation WHERE country_code IS NOT NULL "
    "AND date IS NOT NULL AND wind_generation_zscore IS NOT NULL", "weather_generation"))
def _non_null(m: Models) -> DataFrame:
    """Drop rows without keys (a country's first days have no score)."""
    return m.weather_generation.select("country_code", "date", "wind_generation_zscore").dropna()


@register("filter_in_list", with_ctes(
    f"SELECT * FROM daily WHERE country_code IN {O.FOCUS}", "daily", "groups"))
def _filter_in_list(m: Models) -> DataFrame:
    """P5: rows of the focus countries (the IN-list is the group's member table)."""
    return semi_filter(m.daily, m.focus(), "country_code")


@register("classify_category", with_ctes(
    "SELECT country_code, datetime_utc, production_type, energy_category FROM classified",
    "classified"))
def _classify(m: Models) -> DataFrame:
    """Production type -> energy category (ELSE 'other')."""
    return m.hourly.select("country_code", "datetime_utc", "production_type",
                           classify("production_type", standins.STANDIN_CATEGORY_MAP)
                           .alias("energy_category"))


@register("classify_season", with_ctes(
    "SELECT DISTINCT date, season FROM classified", "classified"))
def _season(m: Models) -> DataFrame:
    """F16: season from the month of the UTC day."""
    day = utc_day("datetime_utc")
    return m.hourly.select(day.alias("date"), season(day).alias("season")).distinct()


@register("event_period", with_ctes(
    "SELECT DISTINCT date, CASE WHEN date < DATE '1999-01-01' THEN 'pre_brell' "
    "ELSE 'post_brell' END AS brell_period FROM daily", "daily"))
def _event_period(m: Models) -> DataFrame:
    """before/after marker; the event day is 'after'."""
    return m.daily.select("date", period("date", standins.STANDIN_EVENT_DATE)
                          .alias("brell_period")).distinct()


@register("range_violations", with_ctes(
    "SELECT country_code, year, renewable_share_pct FROM profile "
    "WHERE renewable_share_pct < 30 OR renewable_share_pct > 36", "profile"))
def _range(m: Models) -> DataFrame:
    """Yearly renewable share outside a band that some years leave."""
    return Q.in_range(m.profile, "renewable_share_pct", 30, 36,
                      select=["country_code", "year", "renewable_share_pct"])


@register("having_low_volume", with_ctes(
    "SELECT country_code, date, CAST(count(*) AS BIGINT) AS row_count FROM daily "
    "GROUP BY country_code, date HAVING count(*) < 4", "daily"))
def _low_volume(m: Models) -> DataFrame:
    """(country, date) with fewer than 4 category rows."""
    return Q.min_rows(m.daily, ["country_code", "date"], 4)


@register("zscore_anomaly_flags", with_ctes(
    "SELECT country_code, date, wind_generation_zscore, solar_generation_zscore, "
    "is_wind_anomaly, is_solar_anomaly FROM weather_generation", "weather_generation"))
def _flags(m: Models) -> DataFrame:
    """abs(rounded z) > 2.5; NULL z -> NULL flag."""
    return m.weather_generation.select("country_code", "date", "wind_generation_zscore",
                                       "solar_generation_zscore", "is_wind_anomaly",
                                       "is_solar_anomaly")


# ---------------------------------------------------------------- joins ----

@register("join_group_membership", with_ctes(
    "SELECT p.country_code, p.year, p.renewable_share_pct, g.group_name "
    "FROM profile p JOIN groups g ON p.country_code = g.country_code", "profile", "groups"))
def _join_groups(m: Models) -> DataFrame:
    """Many-to-many fan-out to group membership."""
    return fan_out(m.profile.select("country_code", "year", "renewable_share_pct"),
                   m.groups.select("country_code", "group_name"), "country_code")


@register("join_country_reference", O.model("profile"))
def _join_reference(m: Models) -> DataFrame:
    """Country-year aggregate left-joined to the reference dimension."""
    return m.profile


@register("join_weather_daily", with_ctes("SELECT * FROM wg_joined", "wg_joined"))
def _join_weather(m: Models) -> DataFrame:
    """Daily generation left-joined to weather on (country, date)."""
    gen = I.weather_daily_generation(m.rollup)
    return gen.join(m.weather.select("country_code", "date", *I.WEATHER_COLUMNS),
                    ["country_code", "date"], "left")


@register("join_detail_to_aggregate", O.model("weather_correlation"), reuses_rollup=True)
def _join_detail(m: Models) -> DataFrame:
    """Daily detail re-joined to its (country, season, year) aggregate."""
    wg = m.weather_generation
    detail = wg.withColumns({"year": year_of("date"), "month_num": F.month("date").cast("bigint")})
    agg = M.seasonal_correlation(wg)
    return join_detail_to_aggregate(detail, agg, ["country_code", "season", "year"])


@register("delta_from_baseline", with_ctes(
    "SELECT country_code, date, renewable_share_pct, core_avg_renewable_pct, "
    "delta_from_core_baseline FROM event_story", "event_story"), reuses_rollup=True)
def _delta_baseline(m: Models) -> DataFrame:
    """Focus share minus the baseline share of the same date."""
    return m.event_story.select("country_code", "date", "renewable_share_pct",
                                "core_avg_renewable_pct", "delta_from_core_baseline")


@register("resilience_score", O.model("resilience"), reuses_rollup=True)
def _resilience(m: Models) -> DataFrame:
    """Chain of left joins and the weighted composite score."""
    return m.resilience


@register("yearly_with_annual_stats", O.model("yearly"))
def _yearly(m: Models) -> DataFrame:
    """Yearly generation joined to annual statistics through the crosswalk."""
    return m.yearly


# ---------------------------------------------------------- aggregations ----

@register("daily_generation", O.model("daily"))
def _daily(m: Models) -> DataFrame:
    """Sum of generation and mean load per (country, UTC day, category)."""
    return m.daily


_COND = {c: f"energy_category = '{c}'" for c in ["renewable", "fossil", "nuclear", "other"]}


@register("conditional_sums", with_ctes(
    "SELECT country_code, date, "
    + ", ".join(f"{ES('generation_mwh', cond)} AS {c}_mwh" for c, cond in _COND.items())
    + f", {ES('generation_mwh')} AS total_mwh FROM daily GROUP BY country_code, date", "daily"))
def _conditional_sums(m: Models) -> DataFrame:
    """A3: pivot-like conditional sums per (country, date)."""
    conds = {f"{c}_mwh": F.col("energy_category") == c
             for c in ["renewable", "fossil", "nuclear", "other"]}
    conds["total_mwh"] = F.lit(True)
    return A.conditional_sums(m.daily, ["country_code", "date"], "generation_mwh", conds)


@register("share_of_total", with_ctes(
    "SELECT country_code, year, renewable_share_pct, fossil_dependency_score FROM profile_agg",
    "profile_agg"))
def _share_of_total(m: Models) -> DataFrame:
    """A4: null-safe percentage shares per (country, year)."""
    return I.country_year_shares(m.daily).select("country_code", "year", "renewable_share_pct",
                                                 "fossil_dependency_score")


@register("share_coarse_denominator", with_ctes(
    "SELECT country_code, month, energy_category, generation_mwh, renewable_share_pct "
    "FROM em_share", "em_share"))
def _share_coarse(m: Models) -> DataFrame:
    """A5: share whose denominator is the whole country-month (on each category row)."""
    return m.energy_mix.select("country_code", "month", "energy_category", "generation_mwh",
                               "renewable_share_pct")


@register("masked_average", with_ctes(
    "SELECT date, core_avg_renewable_mwh FROM core_baseline", "core_baseline"))
def _masked_avg(m: Models) -> DataFrame:
    """AVG over the renewable rows only (CASE without ELSE) per date, baseline group."""
    base = semi_filter(m.daily, m.baseline(), "country_code")
    return base.groupBy("date").agg(
        masked_avg("generation_mwh", F.col("energy_category") == "renewable")
        .alias("core_avg_renewable_mwh"))


@register("count_qualifying_days", with_ctes("SELECT * FROM ind_days", "ind_days"))
def _qualifying(m: Models) -> DataFrame:
    """Days per (country, year) with rounded share > 80."""
    return A.count_qualifying_days(m.daily, ["country_code"], "date", "generation_mwh",
                                   F.col("energy_category") == "renewable", 80)


@register("seasonal_correlation", with_ctes("SELECT * FROM correlations", "correlations"))
def _correlation(m: Models) -> DataFrame:
    """A10: Pearson correlation per (country, season, year), NULL when undefined."""
    return M.seasonal_correlation(m.weather_generation)


@register("correlation_from_comoments", with_ctes("SELECT * FROM correlations", "correlations"))
def _correlation_blocks(m: Models) -> DataFrame:
    """Correlations merged from stored monthly co-moments. The blocks are built from the days
    up to a year before the end and then refreshed with the months of the days since."""
    root, spark = _scratch(m, "comoments"), m.spark
    m.weather_generation.write.parquet(f"{root}/wg")
    wg = spark.read.parquet(f"{root}/wg")
    cut = max_date(wg) - _dt.timedelta(days=365)
    refresh_blocks(spark, wg.filter(F.col("date") < F.lit(cut)), f"{root}/blocks")
    since_cut = touched_days(wg.filter(F.col("date") >= F.lit(cut)))
    refresh_blocks(spark, wg, f"{root}/blocks", since_cut)
    return merged_correlation(spark.read.parquet(f"{root}/blocks"))


@register("qualifying_days_bitmap", with_ctes("SELECT * FROM ind_days", "ind_days"))
def _qualifying_bitmap(m: Models) -> DataFrame:
    """Qualifying days counted from monthly bitmaps, some months loaded twice."""
    renewable = F.col("energy_category") == "renewable"
    blocks = qualifying_blocks(m.daily, ["country_code"], "date", "generation_mwh", renewable, 80)
    again = blocks.filter(F.month("month") % 3 == 0)
    return count_days(blocks.unionByName(again), ["country_code"])


@register("distinct_keys", with_ctes(
    "SELECT DISTINCT country_code, energy_category FROM daily", "daily"))
def _distinct(m: Models) -> DataFrame:
    """Sorted distinct values of two columns."""
    return A.distinct_values(m.daily, ["country_code", "energy_category"])


@register("weather_coverage_gaps", with_ctes(
    "SELECT g.country_code, g.date FROM daily g LEFT JOIN weather w "
    "ON g.country_code = w.country_code AND g.date = w.date WHERE w.date IS NULL "
    "GROUP BY g.country_code, g.date", "daily", "weather"))
def _weather_cov(m: Models) -> DataFrame:
    """Generation days without weather (anti-join + dedup)."""
    return Q.coverage_gaps(m.daily, m.weather, ["country_code", "date"])


@register("load_profile", with_ctes(
    "SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT iso_code) AS BIGINT) "
    "AS distinct_keys, min(year) AS min_value, max(year) AS max_value FROM annual_raw",
    "annual_raw"))
def _load_profile(m: Models) -> DataFrame:
    """Rows, distinct countries, min/max year of a load."""
    return A.load_profile(m.annual_raw, "iso_code", "year")


@register("load_profile_weather", with_ctes(
    "SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT country_code) AS BIGINT) "
    "AS distinct_keys, min(date) AS min_value, max(date) AS max_value FROM weather_raw",
    "weather_raw"))
def _load_profile_weather(m: Models) -> DataFrame:
    """Rows, distinct countries, first/last date of the weather load."""
    return A.load_profile(m.weather_raw, "country_code", "date")


# -------------------------------------------------------------- windows ----

@register("group_average", with_ctes(
    "SELECT country_code, year, group_name, group_avg_renewable_pct FROM group_metrics",
    "group_metrics"))
def _group_avg(m: Models) -> DataFrame:
    """Average over the (group, year) partition."""
    return m.group_metrics.select("country_code", "year", "group_name", "group_avg_renewable_pct")


@register("delta_from_group_avg", with_ctes(
    "SELECT country_code, year, group_name, delta_from_group_avg FROM group_metrics",
    "group_metrics"))
def _group_delta(m: Models) -> DataFrame:
    """Value minus its partition average."""
    return m.group_metrics.select("country_code", "year", "group_name", "delta_from_group_avg")


@register("rank_within_group", with_ctes(
    "SELECT country_code, year, group_name, rank_within_group FROM group_metrics",
    "group_metrics"))
def _rank_group(m: Models) -> DataFrame:
    """RANK within (group, year), best share first."""
    return m.group_metrics.select("country_code", "year", "group_name", "rank_within_group")


@register("rank_overall", with_ctes(
    "SELECT country_code, year, renewable_share_pct, rank_overall FROM gm_ranked", "gm_ranked"))
def _rank_overall(m: Models) -> DataFrame:
    """RANK per year over one row per country (before any group fan-out)."""
    return W.rank_desc(m.profile.select("country_code", "year", "renewable_share_pct"),
                       "renewable_share_pct", ["year"], "rank_overall")


@register("rank_overall_ranges", with_ctes(
    "SELECT country_code, year, renewable_share_pct, rank_overall FROM gm_ranked", "gm_ranked"))
def _rank_ranges(m: Models) -> DataFrame:
    """The same rank by ranges of values, without a task per year."""
    return rank_desc_ranges(m.profile.select("country_code", "year", "renewable_share_pct"),
                            "renewable_share_pct", ["year"], "rank_overall", range_values=50)


@register("rolling_zscore_blocks", with_ctes(
    "SELECT country_code, date, wind_generation_zscore, solar_generation_zscore FROM wg_z", "wg_z"), reuses_rollup=True)
def _zscore_blocks(m: Models) -> DataFrame:
    """The same z-scores over blocks of a year, each with the 89 rows before it."""
    series = I.weather_daily_generation(m.rollup)
    scored = rolling_zscore_blocks(series, {"wind_generation_mwh": "wind_generation_zscore",
                                            "solar_generation_mwh": "solar_generation_zscore"},
                                   ["country_code"], "date", day_blocks("date", 365))
    return scored.select("country_code", "date", "wind_generation_zscore", "solar_generation_zscore")


@register("rolling_mean_90", with_ctes(
    f"SELECT country_code, date, {R('avg(wind_generation_mwh) OVER ' + O.W90, 4)} AS wind_mean_90 "
    "FROM wg_daily", "wg_daily"))
def _rolling_mean(m: Models) -> DataFrame:
    """Trailing 90-row mean per country (rounded to 4 digits)."""
    gen = I.weather_daily_generation(m.rollup)
    return W.rolling_stat(gen, "wind_generation_mwh", ["country_code"], "date", "wind_mean_90",
                          "avg", 90, 4).select("country_code", "date", "wind_mean_90")


@register("rolling_stddev_90", with_ctes(
    f"SELECT country_code, date, {R('stddev_samp(wind_generation_mwh) OVER ' + O.W90, 4)} "
    "AS wind_stddev_90 FROM wg_daily", "wg_daily"))
def _rolling_std(m: Models) -> DataFrame:
    """Trailing 90-row sample standard deviation per country (rounded to 4 digits)."""
    gen = I.weather_daily_generation(m.rollup)
    return W.rolling_stat(gen, "wind_generation_mwh", ["country_code"], "date", "wind_stddev_90",
                          "stddev", 90, 4).select("country_code", "date", "wind_stddev_90")


@register("rolling_zscore", with_ctes(
    "SELECT country_code, date, wind_generation_zscore, solar_generation_zscore FROM wg_z",
    "wg_z"))
def _zscore(m: Models) -> DataFrame:
    """Rolling z-score, NULL-safe, rounded."""
    return m.weather_generation.select("country_code", "date", "wind_generation_zscore",
                                       "solar_generation_zscore")


@register("lag_prior_year", with_ctes(
    "SELECT country_code, month_num, energy_category, year, renewable_share_pct, "
    f"lag(renewable_share_pct) OVER {O.WY} AS prior_share_pct FROM em_share", "em_share"))
def _lag(m: Models) -> DataFrame:
    """Value of the previous present year for the same month and category."""
    shared = m.energy_mix.select("country_code", "month_num", "energy_category", "year",
                                 "renewable_share_pct")
    return W.lag_prior(shared, "renewable_share_pct",
                       ["country_code", "month_num", "energy_category"], "year",
                       "prior_share_pct")


@register("yoy_growth", with_ctes(
    "SELECT country_code, month, energy_category, yoy_renewable_growth_pct FROM energy_mix",
    "energy_mix"))
def _yoy(m: Models) -> DataFrame:
    """Year-over-year growth %, NULL-safe."""
    return m.energy_mix.select("country_code", "month", "energy_category",
                               "yoy_renewable_growth_pct")


# ------------------------------------------------------------ set ops ----

@register("union_all_frames", with_ctes("SELECT * FROM weather_raw", "weather_raw"))
def _union(m: Models) -> DataFrame:
    """Two weather frames (columns in differing order) concatenated by name.

    Even and odd days; a row without a date belongs to the first frame, so every row is in one.
    """
    cols = ["country_code", "date", *WEATHER_FIELDS]
    odd = F.coalesce(F.dayofmonth("date") % 2 == 1, F.lit(False))
    return S.union_frames(m.weather_raw.filter(~odd).select(*cols), m.weather_raw.filter(odd).select(*reversed(cols)))


@register("coverage_gaps", with_ctes(
    "SELECT a.country_code_iso3, a.year FROM (SELECT r.code AS country_code_iso3, y.year "
    "FROM (SELECT unnest([" + ", ".join(f"'{c}'" for c in REQUIRED_ISO) + "]) AS code) r, "
    "(SELECT DISTINCT year FROM annual) y) a LEFT JOIN annual e "
    "ON a.country_code_iso3 = e.country_code_iso3 AND a.year = e.year "
    "WHERE e.country_code_iso3 IS NULL", "annual"))
def _coverage(m: Models) -> DataFrame:
    """Required keys x observed years minus the rows present."""
    return Q.grid_gaps(m.annual, "country_code_iso3", REQUIRED_ISO, "year").select(
        "country_code_iso3", "year")


@register("date_spine", with_ctes(
    "SELECT country_code, CAST(d AS DATE) AS expected_date FROM (SELECT country_code, "
    "min(date) AS lo, max(date) AS hi FROM daily GROUP BY country_code) b, "
    "LATERAL unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), "
    "INTERVAL 1 DAY)) AS t(d)", "daily"))
def _spine(m: Models) -> DataFrame:
    """Every day between each country's first and last date."""
    return S.date_spine(m.daily, ["country_code"], "date")


@register("date_gaps", with_ctes(
    "SELECT s.country_code, s.expected_date AS missing_date FROM (SELECT country_code, "
    "CAST(lo + CAST(i AS INTEGER) AS DATE) AS expected_date FROM (SELECT country_code, "
    "min(date) AS lo, max(date) AS hi, date_diff('day', min(date), max(date)) AS total_days "
    "FROM daily GROUP BY country_code) b, LATERAL unnest(range(0, total_days + 1)) AS t(i)) s "
    "LEFT JOIN (SELECT DISTINCT country_code, date FROM daily) a "
    "ON s.country_code = a.country_code AND s.expected_date = a.date WHERE a.date IS NULL",
    "daily"), reuses_rollup=True)
def _gaps(m: Models) -> DataFrame:
    """Days missing inside each country's date range."""
    return Q.date_gaps(m.daily, ["country_code"], "date")


@register("date_gap_runs", with_ctes(
    "SELECT country_code, CAST(date + 1 AS DATE) AS gap_start, CAST(nxt - 1 AS DATE) AS gap_end, "
    "CAST(nxt - date - 1 AS BIGINT) AS days FROM (SELECT country_code, date, "
    "lead(date) OVER (PARTITION BY country_code ORDER BY date) AS nxt "
    "FROM (SELECT DISTINCT country_code, date FROM daily) u) s WHERE nxt - date > 1", "daily"))
def _gap_runs(m: Models) -> DataFrame:
    """Runs of missing days with their first and last day and length."""
    return S.gap_runs(m.daily, ["country_code"], "date")


@register("date_island_runs", with_ctes(
    "SELECT country_code, min(date) AS island_start, max(date) AS island_end, CAST(count(*) AS BIGINT) AS days "
    "FROM (SELECT country_code, date, date_diff('day', DATE '1970-01-01', date) - "
    "row_number() OVER (PARTITION BY country_code ORDER BY date) AS run "
    "FROM (SELECT DISTINCT country_code, date FROM daily) u) s GROUP BY country_code, run", "daily"))
def _island_runs(m: Models) -> DataFrame:
    """Q9: runs of consecutive present days."""
    return S.island_runs(m.daily, ["country_code"], "date")


# ----------------------------------------------------------- scalars (F*) ----

@register("round_half_up", with_ctes(
    f"SELECT country_code, date, energy_category, {R('load_mwh', 2)} AS load_mwh_2, "
    f"{R('load_mwh', 0)} AS load_mwh_0 FROM daily", "daily"))
def _round(m: Models) -> DataFrame:
    """half-up rounding on the decimal value."""
    return m.daily.select("country_code", "date", "energy_category",
                          round_half_up("load_mwh", 2).alias("load_mwh_2"),
                          round_half_up("load_mwh", 0).alias("load_mwh_0"))


@register("safe_ratio", with_ctes(
    "SELECT country_code, date, energy_category, generation_mwh / nullif(load_mwh, 0) "
    "AS generation_to_load FROM daily", "daily"))
def _safe_ratio(m: Models) -> DataFrame:
    """division guarded by NULLIF."""
    return m.daily.select("country_code", "date", "energy_category",
                          safe_ratio("generation_mwh", "load_mwh").alias("generation_to_load"))


@register("unit_conversion", with_ctes(
    "SELECT w.country_code, w.date, w.sunshine_duration, s.sunshine_duration_hrs "
    "FROM weather_raw w JOIN weather s ON w.country_code = s.country_code AND w.date = s.date",
    "weather_raw", "weather"))
def _units(m: Models) -> DataFrame:
    """seconds -> hours, rounded to 2 digits."""
    from gridmix.plans.staging import seconds_to_hours
    return m.weather_raw.select("country_code", "date", "sunshine_duration",
                                seconds_to_hours(F.col("sunshine_duration"))
                                .alias("sunshine_duration_hrs"))


@register("date_parts", with_ctes(
    f"SELECT DISTINCT date, CAST(date_trunc('month', date) AS DATE) AS month, {YEAR('date')} "
    f"AS year, {MONTH('date')} AS month_num FROM daily", "daily"))
def _date_parts(m: Models) -> DataFrame:
    """First day of month, year and month number."""
    return date_parts(m.daily.select("date").distinct(), "date")


@register("date_arithmetic", with_ctes(
    "SELECT country_code, min(date) AS min_date, max(date) AS max_date, "
    "CAST(date_diff('day', min(date), max(date)) AS BIGINT) AS total_days, "
    "CAST(max(date) - INTERVAL 3 DAY AS DATE) AS lookback_from, "
    "CAST(min(date) + INTERVAL 1 DAY AS DATE) AS day_after_first FROM daily GROUP BY country_code",
    "daily"))
def _date_arith(m: Models) -> DataFrame:
    """DATE_SUB/DATE_ADD by days and DATE_DIFF in days."""
    b = m.daily.groupBy("country_code").agg(F.min("date").alias("min_date"),
                                            F.max("date").alias("max_date"))
    return b.select("country_code", "min_date", "max_date",
                    F.datediff("max_date", "min_date").cast("bigint").alias("total_days"),
                    F.date_sub("max_date", 3).alias("lookback_from"),
                    F.date_add("min_date", 1).alias("day_after_first"))


@register("target_progress", with_ctes(
    "SELECT country_code, year, pct_progress_toward_2030_target, gap_to_2030_target_pct "
    "FROM independence", "independence"), reuses_rollup=True)
def _progress(m: Models) -> DataFrame:
    """progress and gap to target; NULL target -> NULL."""
    return m.independence.select("country_code", "year", "pct_progress_toward_2030_target",
                                 "gap_to_2030_target_pct")


@register("emissions_avoided", with_ctes(
    "SELECT country_code, year, co2_avoided_tonnes FROM independence", "independence"), reuses_rollup=True)
def _emissions(m: Models) -> DataFrame:
    """avoided emissions against a 300 g/kWh baseline."""
    return m.independence.select("country_code", "year", "co2_avoided_tonnes")


# ------------------------------------------------------- data quality (Q*) ----

_DAILY_NOT_NULL = ["country_code", "date", "energy_category", "season", "generation_mwh"]
_ACCEPTED = {"energy_category": ["renewable", "fossil", "nuclear", "other"],
             "season": ["winter", "spring", "summer", "autumn"]}


def _dq_not_null_sql() -> str:
    parts = [f"SELECT 'int_generation_daily' AS table_name, 'not_null' AS check_name, "
             f"'{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM daily"
             for c in _DAILY_NOT_NULL]
    parts += [f"SELECT 'int_generation_daily', 'accepted_values', '{c}', "
              f"CAST(count_if({c} IS NOT NULL AND {c} NOT IN {_in(v)}) AS BIGINT) FROM daily"
              for c, v in _ACCEPTED.items()]
    return with_ctes(" UNION ALL ".join(parts), "daily")


@register("dq_not_null", _dq_not_null_sql())
def _dq_not_null(m: Models) -> DataFrame:
    """Q1/Q3: not-null and accepted-values checks of one table folded into one scan."""
    return Q.column_checks(m.daily, "int_generation_daily", _DAILY_NOT_NULL, _ACCEPTED)


@register("dq_unique", with_ctes(
    "SELECT country_code, CAST(count(*) AS BIGINT) AS n_records FROM groups "
    "WHERE country_code IS NOT NULL GROUP BY country_code HAVING count(*) > 1", "groups"))
def _dq_unique(m: Models) -> DataFrame:
    """Q2: values that occur more than once (countries in two groups)."""
    return Q.unique(m.groups, "country_code")


@register("dq_accepted_values", with_ctes(
    f"SELECT * FROM groups WHERE group_name IS NOT NULL AND group_name NOT IN {_in(GROUP_NAMES)}",
    "groups"))
def _dq_accepted(m: Models) -> DataFrame:
    """Q3: values outside the accepted list (NULL passes)."""
    return Q.accepted_values(m.groups, "group_name", GROUP_NAMES)


@register("dq_non_negative", with_ctes(
    "SELECT country_code, date, wind_generation_zscore FROM weather_generation "
    "WHERE wind_generation_zscore < 0", "weather_generation"))
def _dq_nonneg(m: Models) -> DataFrame:
    """Q6: negative values (of a column that has some)."""
    return Q.non_negative(m.weather_generation, "wind_generation_zscore",
                          select=["country_code", "date", "wind_generation_zscore"])


@register("dq_ratio_threshold", with_ctes(
    f"SELECT country_code, date, wind_generation_mwh, solar_generation_mwh, "
    f"{R('wind_generation_mwh / nullif(solar_generation_mwh, 0)')} AS generation_to_load_ratio FROM weather_generation "
    "WHERE wind_generation_mwh > solar_generation_mwh * 1.5 AND solar_generation_mwh > 0", "weather_generation"))
def _dq_ratio(m: Models) -> DataFrame:
    """Q7: one measure above 1.5 x another (above 0), with the rounded ratio."""
    return Q.ratio_above(m.weather_generation, "wind_generation_mwh", "solar_generation_mwh", 1.5,
                         select=["country_code", "date", "wind_generation_mwh", "solar_generation_mwh"])


def _report_sql() -> str:
    checks = [
        ("assert_generation_non_negative", "error", "SELECT 1 FROM daily WHERE generation_mwh < 0"),
        ("assert_renewable_share_range", "error",
         "SELECT 1 FROM profile WHERE renewable_share_pct < 0 OR renewable_share_pct > 100"),
        ("assert_load_gte_generation", "warn",
         "SELECT 1 FROM daily WHERE generation_mwh > load_mwh * 1.5 AND load_mwh > 0"),
        ("assert_row_volume", "error",
         "SELECT country_code, date FROM daily GROUP BY country_code, date HAVING count(*) < 4"),
        ("assert_weather_date_coverage", "warn",
         "SELECT g.country_code, g.date FROM daily g LEFT JOIN weather w ON g.country_code = "
         "w.country_code AND g.date = w.date WHERE w.date IS NULL GROUP BY g.country_code, g.date"),
    ]
    parts = [f"SELECT '{n}' AS check_name, '{s}' AS severity, CAST(count(*) AS BIGINT) AS failures, "
             f"CASE WHEN count(*) = 0 THEN 'pass' ELSE '{s}' END AS status FROM ({q}) t"
             for n, s, q in checks]
    return with_ctes(" UNION ALL ".join(parts), "daily", "profile", "weather")


@register("dq_report", _report_sql(), reuses_rollup=True)
def _dq_report(m: Models) -> DataFrame:
    """Q4: check report with severities (error / warn) and pass/fail status."""
    d = m.daily
    by_row = Q.row_report(d, {
        "assert_generation_non_negative": (Q.outside("generation_mwh", lo=0), "error"),
        "assert_load_gte_generation": (Q.exceeds("generation_mwh", "load_mwh", 1.5), "warn")})
    return by_row.unionByName(Q.report([
        Q.Check("assert_renewable_share_range",
                Q.in_range(m.profile, "renewable_share_pct", 0, 100), "error"),
        Q.Check("assert_row_volume", Q.min_rows(d, ["country_code", "date"], 4), "error"),
        Q.Check("assert_weather_date_coverage",
                Q.coverage_gaps(d, m.weather, ["country_code", "date"]), "warn"),
    ]))


@register("source_freshness", f"""
SELECT event_type AS source_name, max(ts) AS max_loaded_at,
       {R("(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000 / 3600")}
         AS age_hours,
       CASE WHEN max(ts) IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000 > 2 * 86400 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000 > 1 * 86400 THEN 'warn'
            ELSE 'pass' END AS status
FROM events GROUP BY event_type""")
def _freshness(m: Models) -> DataFrame:
    """Q12: newest load time per source against warn/error ages (1 and 2 days)."""
    src = standins.freshness_source(m.spark, m.sf_dir)
    return Q.freshness(src, "_loaded_at", standins.STANDIN_FRESHNESS_AS_OF, 1, 2,
                       keys=["source_name"])
