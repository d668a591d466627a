"""End-to-end run on real-shaped raw files: build all models twice (full, then
incremental) and run the data-quality suite."""

import datetime as dt
import json
import os
from dataclasses import replace

from pyspark.sql import functions as F

from gridmix.constants import COUNTRIES_ISO2, COUNTRIES_ISO3, OWID_COLUMNS
from gridmix.plans.warehouse import RawInputs, build_models, load_raw, run_checks
from tests.helpers import hourly

TYPES = ["Solar", "Wind Onshore", "Fossil Gas", "Nuclear", "Biomass"]


def _raw(spark, root, days):
    rows = []
    for c_i, c in enumerate(COUNTRIES_ISO2):
        for i in range(days):
            day = dt.date(2025, 1, 20) + dt.timedelta(days=i)
            for h in (0, 12):
                for t_i, t in enumerate(TYPES):
                    g = (i * 7 + c_i * 3 + t_i * 5 + h) % 40
                    rows.append((c, f"{day} {h:02d}:00", t, g, 300 + c_i))
    hourly(spark, rows).withColumn("_loaded_at", F.col("datetime_utc")).write.mode(
        "overwrite").parquet(os.path.join(root, "generation"))
    wdir = os.path.join(root, "weather")
    os.makedirs(wdir, exist_ok=True)
    dates = [(dt.date(2025, 1, 20) + dt.timedelta(days=i)).isoformat() for i in range(days)]
    for c_i, c in enumerate(COUNTRIES_ISO2):
        doc = {"daily": {"time": dates,
                         "wind_speed_10m_max": [float((i + c_i) % 17) for i in range(days)],
                         "sunshine_duration": [float(3600 * (i % 9)) for i in range(days)],
                         "temperature_2m_mean": [1.0] * days, "precipitation_sum": [0.0] * days,
                         "cloud_cover_mean": [50.0] * days}}
        json.dump(doc, open(os.path.join(wdir, f"weather_{c}.json"), "w"))
    lines = [",".join(OWID_COLUMNS + ["extra"])]
    for iso in COUNTRIES_ISO3:
        for year in (2024, 2025):
            vals = {"iso_code": iso, "country": iso.title(), "year": str(year),
                    "carbon_intensity_elec": "250"}
            lines.append(",".join(vals.get(c, "10.0") for c in OWID_COLUMNS) + ",x")
    # Out of scope: years before the first, and a country that no list names.
    for iso, year in [(COUNTRIES_ISO3[0], 2019), (COUNTRIES_ISO3[1], 1990), ("USA", 2024)]:
        vals = {"iso_code": iso, "country": iso.title(), "year": str(year)}
        lines.append(",".join(vals.get(c, "10.0") for c in OWID_COLUMNS) + ",x")
    open(os.path.join(root, "owid.csv"), "w").write("\n".join(lines) + "\n")
    return RawInputs(generation=os.path.join(root, "generation"), weather=wdir,
                     annual=os.path.join(root, "owid.csv"), weather_format="json",
                     weather_country_pattern=r"weather_([A-Z]{2})\.json")


def test_build_models_and_checks(spark, tmp_dir):
    raw = _raw(spark, os.path.join(tmp_dir, "raw"), 20)
    out = os.path.join(tmp_dir, "wh")
    paths = build_models(spark, raw, out)
    assert len(paths) == 11          # staging models are views
    daily = spark.read.parquet(paths["int_generation_daily"])
    assert daily.count() == 11 * 20 * 4
    prof = spark.read.parquet(paths["int_country_profile"])
    no = prof.filter(F.col("country_code") == "NO").first()
    assert no.eu_target_2030_pct is None
    ind = spark.read.parquet(paths["mart_country_independence"])
    assert ind.filter(F.col("co2_avoided_tonnes").isNull()).count() == 0   # crosswalk resolves ISO3
    gm = spark.read.parquet(paths["int_country_group_metrics"])
    assert gm.filter(F.col("country_code") == "LT").count() == 2 * 1
    story = spark.read.parquet(paths["mart_baltic_story"])
    assert {r.brell_period for r in story.collect()} == {"pre_brell", "post_brell"}

    # Second run is incremental and must not change anything.
    before = sorted(tuple(r) for r in spark.read.parquet(paths["int_weather_generation"]).collect())
    build_models(spark, raw, out)
    after = sorted(tuple(r) for r in spark.read.parquet(paths["int_weather_generation"]).collect())
    assert before == after

    as_of = dt.datetime(2025, 2, 9, 12, 0)
    gen = spark.read.parquet(raw.generation)
    report = {r.check_name: r for r in run_checks(
        spark, raw, paths, as_of, loaded_at={"entsoe_generation": gen}).collect()}
    assert report["assert_generation_non_negative"].status == "pass"
    assert report["accepted_values:int_generation_daily.energy_category"].status == "pass"
    assert report["unique:stg_country_reference.country_code"].status == "pass"
    assert report["assert_owid_country_coverage"].status == "pass"
    assert report["assert_weather_date_coverage"].status == "pass"
    assert report["freshness:entsoe_generation"].status == "pass"
    # every country-day has all four categories
    assert report["assert_row_volume_entsoe"].failures == 0
    # Rows out of scope were not loaded, so they are neither wrong values nor gaps.
    assert report["accepted_values:stg_owid_energy.country_code_iso3"].status == "pass"
    assert len(report) == 57         # 48 of columns, 7 singular, bad values, freshness


def test_load_raw_scopes_stamps_and_counts(spark, tmp_dir):
    landing = _raw(spark, os.path.join(tmp_dir, "raw"), 3)
    with open(landing.annual, "a") as f:
        bad = {"iso_code": COUNTRIES_ISO3[2], "country": "x", "year": "n/a", "solar_share_elec": "?"}
        f.write(",".join(bad.get(c, "1.0") for c in OWID_COLUMNS) + ",x\n")
    raw = load_raw(spark, landing, os.path.join(tmp_dir, "wh"))
    annual = spark.read.parquet(raw.annual)
    assert annual.filter("year is not null").count() == 2 * len(COUNTRIES_ISO3)
    assert [r._bad_values for r in annual.filter("year is null").collect()] == [2]
    assert annual.filter("_loaded_at is null").count() == 0
    weather = spark.read.parquet(raw.weather)
    assert weather.count() == 3 * len(COUNTRIES_ISO2)
    loaded = annual.count()
    raw = load_raw(spark, landing, os.path.join(tmp_dir, "wh"))
    assert spark.read.parquet(raw.annual).count() == loaded       # replaced, not added

    paths = build_models(spark, raw, os.path.join(tmp_dir, "wh"))
    now = dt.datetime.now(dt.timezone.utc)
    report = {r.check_name: r for r in run_checks(spark, raw, paths, now).collect()}
    assert report["bad_values:owid_energy"].failures == 1
    assert report["freshness:owid_energy"].status == report["freshness:weather_daily"].status == "pass"
    assert report["not_null:stg_owid_energy.year"].failures == 0
    one = replace(landing, weather_days=("2025-01-21", "2025-01-21"))
    kept = spark.read.parquet(load_raw(spark, one, os.path.join(tmp_dir, "one")).weather)
    assert kept.count() == len(COUNTRIES_ISO2)
