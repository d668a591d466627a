"""File sources and sinks: wide CSV, JSON parallel arrays, seeds, writers."""

import json
import os

from pyspark.sql import functions as F

from gridmix import seeds
from gridmix.constants import OWID_COLUMNS
from gridmix.plans.staging import stg_annual_stats, stg_country_reference, stg_weather
from gridmix.sources.readers import read_owid, read_weather_json, recent_days, scope_filter
from gridmix.sources.sinks import layer_path, write_csv, write_table
from tests.helpers import d, rows


def test_read_owid_missing_column_and_scope(spark, tmp_dir):
    path = os.path.join(tmp_dir, "owid.csv")
    cols = [c for c in OWID_COLUMNS if c != "hydro_share_elec"] + ["unrelated"]
    lines = [",".join(cols)]
    for iso, year in [("DEU", 2019), ("DEU", 2021), ("USA", 2021), ("", 2021), ("NOR", 2025)]:
        vals = {"iso_code": iso, "country": iso.lower(), "year": str(year)}
        lines.append(",".join(vals.get(c, "1.5" if c != "unrelated" else "x") for c in cols))
    open(path, "w").write("\n".join(lines) + "\n")
    df, missing = read_owid(spark, path)
    assert missing == ["hydro_share_elec"]
    scoped = scope_filter(df, "iso_code", ["DEU", "NOR"], "year", 2020, 2025)
    assert sorted((r.iso_code, r.year) for r in scoped.collect()) == [("DEU", 2021), ("NOR", 2025)]
    staged = stg_annual_stats(df.withColumn("hydro_share_elec", F.lit(None).cast("double")))
    assert staged.count() == 4          # the row without iso code is dropped
    assert dict(staged.dtypes)["year"] == "bigint"


def test_read_weather_json_parallel_arrays(spark, tmp_dir):
    doc = {"daily": {"time": ["2024-01-01", "2024-01-02", "2024-01-03"],
                     "wind_speed_10m_max": [10.0, 20.0, 30.0],
                     "sunshine_duration": [3600.0, 7200.0, 5400.0],
                     "temperature_2m_mean": [1.0, 2.0, 3.0],
                     "precipitation_sum": [0.0, 0.5, 1.0],
                     "cloud_cover_mean": [50.0, 60.0, 70.0]}}
    folder = os.path.join(tmp_dir, "weather")
    os.makedirs(folder)
    for c in ("DE", "FR"):
        json.dump(doc, open(os.path.join(folder, f"weather_{c}.json"), "w"))
    raw = read_weather_json(spark, folder, country_pattern=r"weather_([A-Z]{2})\.json")
    staged = stg_weather(raw)
    got = rows(staged, "country_code", "date", "wind_speed_10m_max_kmh", "sunshine_duration_hrs",
               order=["country_code", "date"])
    assert got[:3] == [("DE", d("2024-01-01"), 10.0, 1.0), ("DE", d("2024-01-02"), 20.0, 2.0),
                       ("DE", d("2024-01-03"), 30.0, 1.5)]
    assert len(got) == 6
    single = read_weather_json(spark, os.path.join(folder, "weather_DE.json"), country="DE")
    assert single.count() == 3


def test_seeds_typed(spark):
    ref = stg_country_reference(seeds.country_reference(spark))
    assert ref.count() == 11
    no = ref.filter(F.col("country_code") == "NO").first()
    assert no.eu_target_2030_pct is None and no.is_eu_member is False
    groups = seeds.country_group_membership(spark)
    assert groups.filter(F.col("country_code") == "LT").count() == 2
    assert seeds.country_crosswalk(spark).count() == 11


def test_recent_days(spark):
    df = spark.createDataFrame([(d("2025-01-01"),), (d("2025-01-30"),), (d("2025-01-31"),)],
                               "date date")
    assert [r.date for r in recent_days(df, "date", 1, as_of="2025-01-31").collect()] == [
        d("2025-01-30"), d("2025-01-31")]


def test_writers(spark, tmp_dir):
    df = spark.createDataFrame([("DE", d("2025-01-01"), 1.0), ("DE", d("2025-01-02"), 2.0)],
                               "country_code string, date date, v double")
    path = layer_path(tmp_dir, "intermediate", "t")
    write_table(df, path, partition_by="date", loaded_at=True)
    back = spark.read.parquet(path)
    assert back.count() == 2 and "_loaded_at" in back.columns
    assert [p for p in sorted(os.listdir(path)) if p.startswith("date=")] == [
        "date=2025-01-01", "date=2025-01-02"]
    write_csv(df, os.path.join(tmp_dir, "sample"))
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "sample")).count() == 2


def test_materialize_writes_under_the_checkpoint_dir(spark):
    from gridmix.session import ensure_checkpoint_dir
    from gridmix.sources.sinks import materialize
    def norm(p):
        return "/" + p.replace("file:", "").lstrip("/")
    root = norm(ensure_checkpoint_dir(spark)).rstrip("/")
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "unit-test")
    files = [norm(f) for f in df.inputFiles()]
    assert files and all(f.startswith(root + "/gridmix-unit-test-") for f in files)
    assert df.agg(F.sum("x")).first()[0] == 90
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()  # lineage cut


def test_read_owid_finds_columns_by_name_in_each_file(spark, tmp_dir):
    """Files with other column orders, a file without a column, and one with an extra column."""
    folder = os.path.join(tmp_dir, "owid")
    os.makedirs(folder)
    files = {"a.csv": ["iso_code", "country", "year", "renewables_share_elec", "solar_share_elec"],
             "b.csv": ["solar_share_elec", "extra", "renewables_share_elec", "year", "iso_code", "country"],
             "c.csv": ["iso_code", "country", "year", "solar_share_elec"]}
    for name, cols in files.items():
        values = {"iso_code": name[0].upper() * 3, "country": "x", "year": "2024", "extra": "?",
                  "renewables_share_elec": "20", "solar_share_elec": "3"}
        open(os.path.join(folder, name), "w").write(",".join(cols) + "\n" + ",".join(values[c] for c in cols) + "\n")
    df, missing = read_owid(spark, folder, bad_col="bad")
    assert "renewables_share_elec" not in missing and "hydro_share_elec" in missing
    assert rows(df, "iso_code", "year", "renewables_share_elec", "solar_share_elec", "bad", order=["iso_code"]) == [
        ("AAA", 2024, 20.0, 3.0, 0), ("BBB", 2024, 20.0, 3.0, 0), ("CCC", 2024, None, 3.0, 0)]


def test_full_replace_removes_partitions_that_are_gone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for mode in ("dynamic", "static"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        write_table(spark.createDataFrame([(1, d("2025-01-01")), (2, d("2025-01-02"))], "v int, date date"), path, "date")
        write_table(spark.createDataFrame([(3, d("2025-01-02"))], "v int, date date"), path, "date")
        assert rows(spark.read.parquet(path), "v", "date") == [(3, d("2025-01-02"))]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_rejected_records_are_counted(spark, tmp_dir):
    from gridmix.sources.readers import split_owid, split_weather_json

    folder = os.path.join(tmp_dir, "csv")
    os.makedirs(folder)
    open(os.path.join(folder, "a.csv"), "w").write(
        "iso_code,country,year,solar_share_elec\nAAA,a,2024,1\nBBB,b,2024\nCCC,c,2024,2,9\nDDD,\"d, e\",2024,x\n")
    open(os.path.join(folder, "b.csv"), "w").write("year,iso_code,country\n2023,EEE,e\n2023\n")
    good, missing, bad = split_owid(spark, folder, bad_col="n_bad")
    assert rows(good, "iso_code", "country", "year", "solar_share_elec", "n_bad", order=["iso_code"]) == [
        ("AAA", "a", 2024, 1.0, 0), ("DDD", "d, e", 2024, None, 1), ("EEE", "e", 2023, None, 0)]
    assert "hydro_share_elec" in missing
    assert sorted((r["file"].rsplit("/", 1)[1], r["key"], r["record"]) for r in bad.collect()) == [
        ("a.csv", "BBB", "BBB,b,2024"), ("a.csv", "CCC", "CCC,c,2024,2,9"), ("b.csv", "2023", "2023")]

    docs = os.path.join(tmp_dir, "json")
    os.makedirs(docs)
    daily = {"time": ["2024-01-01", "2024-01-02"], "wind_speed_10m_max": [1.0, 2.0], "sunshine_duration": [1.0, 2.0],
             "temperature_2m_mean": [1.0, 2.0], "precipitation_sum": [0.0, 0.0], "cloud_cover_mean": [5.0, 6.0]}
    some = {"DE": {"daily": daily}, "FR": {"daily": daily | {"wind_speed_10m_max": [1.0]}}, "NO": {"hourly": 1},
            "SE": {"daily": {k: v for k, v in daily.items() if k != "cloud_cover_mean"}}}
    for name, doc in some.items():
        json.dump(doc, open(os.path.join(docs, f"weather_{name}.json"), "w"))
    open(os.path.join(docs, "weather_EE.json"), "w").write('{"daily": {"time": [')
    json.dump({"daily": daily}, open(os.path.join(docs, "other.json"), "w"))
    good, bad = split_weather_json(spark, docs, r"weather_([A-Z]{2})\.json")
    assert rows(good, "country_code", "date", "cloud_cover_mean", order=["country_code", "date"]) == [
        ("DE", "2024-01-01", 5.0), ("DE", "2024-01-02", 6.0), ("SE", "2024-01-01", None), ("SE", "2024-01-02", None)]
    assert sorted((r["file"].rsplit("/", 1)[1], r["reason"]) for r in bad.collect()) == [
        ("other.json", "no country in the file name"), ("weather_EE.json", "no readable document"),
        ("weather_FR.json", "arrays of 1 to 2 values"), ("weather_NO.json", "no array of days")]
