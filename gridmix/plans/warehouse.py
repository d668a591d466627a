"""Build every model from real-shaped raw tables and run the data-quality suite.

``build_models`` is the equivalent of a full model run: staging models become
temporary views, the two daily tables are refreshed incrementally (3-day
lookback, key upsert, date partitions) and the yearly / profile / group tables
and the marts are written as Parquet tables under ``<out_root>/<layer>/<name>``.
Each downstream table reads its inputs back from the written tables, so a
lost executor never forces recomputation from the raw hourly data.

``run_checks`` evaluates the column tests, the singular tests and the source
freshness rules and returns one report DataFrame.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import seeds
from gridmix.constants import (
    BALTIC_COUNTRIES, CATEGORIES, COUNTRIES_ISO2, COUNTRIES_ISO3, CORE_COUNTRIES, END_YEAR,
    EVENT_LABELS, FRESHNESS_DAYS, GROUPS, LOAD_RATIO, MIN_ROWS_PER_DAY, SEASON_MONTHS, START_YEAR,
    WEATHER_END, WEATHER_START,
)
from gridmix.operators import quality as Q
from gridmix.operators.sets import union_frames
from gridmix.plans import intermediate as I
from gridmix.plans import marts as M
from gridmix.plans import staging
from gridmix.sources.readers import (
    read_generation, read_parquet, scope_filter, split_owid, split_weather_json,
)
from gridmix.sources.sinks import layer_path, write_table
from gridmix.streaming.incremental import (
    checks_path, keep_counts, refresh_daily, since, table_exists,
)


@dataclass
class RawInputs:
    """Where the raw tables live. Weather may be a Parquet table or a folder of
    API JSON documents (one per country, code taken from the file name); the
    annual statistics may be the wide CSV or a Parquet table."""
    generation: str
    weather: str
    annual: str
    weather_format: str = "parquet"          # or "json"
    weather_country_pattern: str = r"([A-Z]{2})\.json$"
    annual_format: str = "csv"               # or "parquet"
    countries: tuple = tuple(COUNTRIES_ISO3)
    years: tuple = (START_YEAR, END_YEAR)
    weather_days: tuple = (WEATHER_START, WEATHER_END)
    quarantine: str | None = None            # rejected records, set by ``load_raw``


#: Column of a raw table that counts the fields of its row that could not be read.
BAD_VALUES = "_bad_values"


def scoped_weather(spark: SparkSession, raw: RawInputs) -> DataFrame:
    """Raw weather of the days in scope."""
    if raw.weather_format == "json":
        df = split_weather_json(spark, raw.weather, raw.weather_country_pattern)[0]
    else:
        df = read_parquet(spark, raw.weather)
    first, last = (F.lit(d).cast("date") for d in raw.weather_days)
    return df.filter(F.col("date").between(first, last))


def scoped_annual(spark: SparkSession, raw: RawInputs) -> DataFrame:
    """Raw yearly statistics of the countries and years in scope. A row of such a
    country with fields that could not be read stays, whatever its year, to be counted."""
    if raw.annual_format == "csv":
        df, _missing, _rejected = split_owid(spark, raw.annual, bad_col=BAD_VALUES)
    else:
        df = read_parquet(spark, raw.annual)
    in_years = F.col("year").between(*raw.years)
    if BAD_VALUES in df.columns:
        in_years = in_years | (F.col("year").isNull() & (F.col(BAD_VALUES) > 0))
    return scope_filter(df, "iso_code", list(raw.countries)).filter(in_years)


def load_raw(spark: SparkSession, landing: RawInputs, out_root: str) -> RawInputs:
    """Read the landed weather and yearly files, scope them, stamp ``_loaded_at`` and
    replace the raw tables under ``<out_root>/raw``; returns where they are.

    The hourly table is a raw table already and is not copied. Records that could
    not be read go to a table of their own (``quarantine``) with file and reason.
    """
    rejected = []
    if landing.weather_format == "json":
        rejected.append(split_weather_json(spark, landing.weather, landing.weather_country_pattern)[1])
    if landing.annual_format == "csv":
        rejected.append(split_owid(spark, landing.annual)[2])
    quarantine = layer_path(out_root, "raw", "quarantine") if rejected else None
    if quarantine:
        write_table(union_frames(*rejected), quarantine, loaded_at=True)
    weather, annual = (layer_path(out_root, "raw", n) for n in ("weather_daily", "owid_energy"))
    write_table(scoped_weather(spark, landing), weather, loaded_at=True)
    write_table(scoped_annual(spark, landing), annual, loaded_at=True)
    return replace(landing, weather=weather, weather_format="parquet", annual=annual,
                   annual_format="parquet", quarantine=quarantine)


def staged_inputs(spark: SparkSession, raw: RawInputs) -> dict[str, DataFrame]:
    """Staging models (views) plus seeds."""
    weather_raw = scoped_weather(spark, raw)
    annual_raw = _with_missing(scoped_annual(spark, raw))
    out = {
        "hourly": read_generation(spark, raw.generation),
        "stg_weather_daily": staging.stg_weather(weather_raw),
        "stg_owid_energy": staging.stg_annual_stats(annual_raw),
        "stg_country_reference": staging.stg_country_reference(seeds.country_reference(spark)),
        "country_group_membership": seeds.country_group_membership(spark),
        "country_crosswalk": seeds.country_crosswalk(spark),
    }
    for name in ("stg_weather_daily", "stg_owid_energy", "stg_country_reference"):
        out[name].createOrReplaceTempView(name)
    return out


def _with_missing(annual_raw: DataFrame) -> DataFrame:
    """Add absent OWID columns as NULL so staging sees the full declared schema."""
    from gridmix.schemas import OWID_RAW
    missing = {f.name: F.lit(None).cast(f.dataType) for f in OWID_RAW.fields
               if f.name not in annual_raw.columns}
    return annual_raw.withColumns(missing) if missing else annual_raw


def build_models(spark: SparkSession, raw: RawInputs, out_root: str,
                 lookback_days: int = 3, dev_days: int | None = None,
                 as_of: _dt.date | None = None) -> dict[str, str]:
    """Run all models; returns ``{model name: table path}``.

    ``dev_days`` turns on the development sample: only hourly rows of the last
    ``dev_days`` days before ``as_of`` (default: today, UTC) feed the daily
    tables. The bound is a literal on the raw timestamp, pushed into the scan.
    Landed files (JSON, CSV) are loaded as raw tables first (``load_raw``).
    """
    if raw.weather_format != "parquet" or raw.annual_format != "parquet":
        raw = load_raw(spark, raw, out_root)
    s = staged_inputs(spark, raw)
    if dev_days is not None:
        anchor = as_of or _dt.datetime.now(_dt.timezone.utc).date()
        s["hourly"] = since(s["hourly"], "datetime_utc", anchor - _dt.timedelta(days=dev_days))
    paths: dict[str, str] = {}

    def put(name: str, layer: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path, checks = layer_path(out_root, layer, name), observed(name)
        write_table(df, path, partition_by=partition_by, checks=checks)
        keep_counts(spark, checks.counts(spark), path)
        paths[name] = path
        return spark.read.parquet(path)

    daily_path = layer_path(out_root, "intermediate", "int_generation_daily")
    wg_path = layer_path(out_root, "intermediate", "int_weather_generation")
    refresh_daily(spark, s["hourly"], s["stg_weather_daily"], daily_path, wg_path, lookback_days,
                  checks={"generation": observed("int_generation_daily"),
                          "weather": observed("int_weather_generation")})
    paths.update(int_generation_daily=daily_path, int_weather_generation=wg_path)
    daily = spark.read.parquet(daily_path)
    wg = spark.read.parquet(wg_path)

    annual, xwalk = s["stg_owid_energy"], s["country_crosswalk"]
    put("int_generation_yearly", "intermediate", I.int_generation_yearly(daily, annual, xwalk))
    profile = put("int_country_profile", "intermediate",
                  I.int_country_profile(daily, s["stg_country_reference"]))
    groups = put("int_country_group_metrics", "intermediate",
                 I.int_country_group_metrics(profile, s["country_group_membership"]))
    put("mart_energy_mix", "marts", M.mart_energy_mix(daily))
    put("mart_weather_correlation", "marts", M.mart_weather_correlation(wg))
    independence = put("mart_country_independence", "marts",
                       M.mart_country_independence(profile, daily, annual, xwalk))
    put("mart_fossil_dependency", "marts", M.mart_fossil_dependency(daily, groups))
    put("mart_resilience_score", "marts", M.mart_resilience_score(profile, groups, independence))
    put("mart_baltic_story", "marts",
        M.mart_event_story(daily, s["stg_weather_daily"], BALTIC_COUNTRIES, CORE_COUNTRIES))
    return paths


#: Columns that must be present, and accepted values, of each table.
COLUMN_CHECKS = [
    ("stg_owid_energy", ["country_code_iso3", "year"], {"country_code_iso3": COUNTRIES_ISO3}),
    ("stg_weather_daily", ["country_code", "date", "wind_speed_10m_max_kmh",
                           "sunshine_duration_hrs", "temperature_avg_c", "precipitation_mm",
                           "cloud_cover_pct"], {"country_code": COUNTRIES_ISO2}),
    ("stg_country_reference", ["country_code", "is_eu_member"], {"country_code": COUNTRIES_ISO2}),
    ("int_generation_daily", ["country_code", "date", "energy_category", "season",
                              "generation_mwh"],
     {"energy_category": CATEGORIES, "season": list(SEASON_MONTHS)}),
    ("int_generation_yearly", ["country_code", "year"], {}),
    ("int_weather_generation", ["country_code", "date"], {}),
    ("int_country_profile", ["country_code", "year", "renewable_share_pct"], {}),
    ("int_country_group_metrics", ["country_code", "group_name"], {"group_name": GROUPS}),
    ("mart_energy_mix", ["country_code", "month", "energy_category"], {}),
    ("mart_weather_correlation", ["country_code", "date"], {}),
    ("mart_country_independence", ["country_code", "year"], {}),
    ("mart_fossil_dependency", ["country_code", "month"], {}),
    ("mart_resilience_score", ["country_code", "year"], {}),
    ("mart_baltic_story", ["country_code", "date", "brell_period"],
     {"country_code": BALTIC_COUNTRIES, "brell_period": list(EVENT_LABELS)}),
]


def observed(name: str) -> Q.ObservedChecks:
    """The column checks of a model, to be counted by the job that writes it."""
    return next(Q.ObservedChecks(name, present, accepted) for n, present, accepted in COLUMN_CHECKS if n == name)


def model_checks(spark: SparkSession, df: DataFrame, name: str, present: list, accepted: dict,
                 path: str | None, unique_columns: list) -> DataFrame:
    """Failures of a model's column checks: the counts its writing job kept, or else one pass over it."""
    if path is None or unique_columns or not table_exists(spark, checks_path(path)):
        return Q.column_checks(df, name, present, accepted, unique_columns)
    kept = spark.read.parquet(checks_path(path))
    return kept.groupBy("table_name", "check_name", "column_name").agg(F.sum("failures").alias("failures"))


def run_checks(spark: SparkSession, raw: RawInputs, paths: dict[str, str], as_of,
               loaded_at: dict[str, DataFrame] | None = None) -> DataFrame:
    """The data-quality suite: one row per check with failures, severity and status.

    Column checks of a model were counted by the job that wrote it (``build_models``), so they
    scan no model table; those of a staging view are one pass over it. ``loaded_at`` maps a
    source name (``owid_energy``, ``weather_daily``, ``entsoe_generation``) to a
    DataFrame with a ``_loaded_at`` column; a raw table that has this column
    itself need not be given.
    """
    s = staged_inputs(spark, raw)
    t = {name: spark.read.parquet(p) for name, p in paths.items()}
    daily, profile = t["int_generation_daily"], t["int_country_profile"]

    unique_columns = {"stg_country_reference": ["country_code"]}
    by_column = reduce(DataFrame.unionByName, [
        model_checks(spark, s[name] if name in s else t[name], name, present, accepted, paths.get(name),
                     unique_columns.get(name, []))
        for name, present, accepted in COLUMN_CHECKS])
    column_report = by_column.select(
        F.concat("check_name", F.lit(":"), "table_name", F.lit("."), "column_name").alias("check_name"),
        F.lit("error").alias("severity"), "failures",
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("error")).alias("status"))

    # Singular tests, with the severities stated in their headers.
    checks = [
        Q.Check("assert_date_continuity", Q.date_gaps(daily, ["country_code"], "date"), "warn"),
        Q.Check("assert_owid_country_coverage",
                Q.grid_gaps(s["stg_owid_energy"], "country_code_iso3", COUNTRIES_ISO3, "year"),
                "error"),
        Q.Check("assert_renewable_share_range",
                Q.in_range(profile, "renewable_share_pct", 0, 100), "error"),
        Q.Check("assert_row_volume_entsoe",
                Q.min_rows(daily, ["country_code", "date"], MIN_ROWS_PER_DAY), "error"),
        Q.Check("assert_weather_date_coverage",
                Q.coverage_gaps(daily, s["stg_weather_daily"], ["country_code", "date"]), "warn"),
    ]
    if raw.quarantine is not None:
        rejected = read_parquet(spark, raw.quarantine)
        checks += [Q.Check(f"quarantine:{name}", rejected.filter(F.col("source") == name))
                   for name in ("owid_energy", "weather_daily")]
    annual = scoped_annual(spark, raw)
    if BAD_VALUES in annual.columns:
        checks.append(Q.Check("bad_values:owid_energy", annual.filter(F.col(BAD_VALUES) > 0)))
    by_row = Q.row_report(daily, {
        "assert_generation_non_negative": (Q.outside("generation_mwh", lo=0), "error"),
        "assert_load_gte_generation": (Q.exceeds("generation_mwh", "load_mwh", LOAD_RATIO), "warn")})
    report = column_report.unionByName(by_row).unionByName(Q.report(checks))

    tables = {"entsoe_generation": raw.generation}
    if raw.weather_format == "parquet":
        tables["weather_daily"] = raw.weather
    if raw.annual_format == "parquet":
        tables["owid_energy"] = raw.annual
    stamped = {name: read_parquet(spark, path) for name, path in tables.items()}
    sources = {name: df for name, df in stamped.items() if "_loaded_at" in df.columns}
    for source, df in (sources | (loaded_at or {})).items():
        warn, error = FRESHNESS_DAYS[source]
        fresh = Q.freshness(df, "_loaded_at", as_of, warn, error)
        report = report.unionByName(fresh.select(
            F.lit(f"freshness:{source}").alias("check_name"),
            F.when(F.col("status") == "pass", F.lit("error")).otherwise(F.col("status"))
            .alias("severity"),
            (F.col("status") != "pass").cast("bigint").alias("failures"),
            F.col("status")))
    return report
