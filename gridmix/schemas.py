"""Declared schemas of raw sources and seeds (no inference anywhere)."""

from pyspark.sql import types as T

OWID_RAW = T.StructType([
    T.StructField("iso_code", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("year", T.LongType()),
    T.StructField("renewables_share_elec", T.DoubleType()),
    T.StructField("low_carbon_share_elec", T.DoubleType()),
    T.StructField("solar_share_elec", T.DoubleType()),
    T.StructField("wind_share_elec", T.DoubleType()),
    T.StructField("hydro_share_elec", T.DoubleType()),
    T.StructField("nuclear_share_elec", T.DoubleType()),
    T.StructField("fossil_share_elec", T.DoubleType()),
    T.StructField("solar_electricity", T.DoubleType()),
    T.StructField("wind_electricity", T.DoubleType()),
    T.StructField("carbon_intensity_elec", T.DoubleType()),
])

WEATHER_RAW = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("wind_speed_10m_max", T.DoubleType()),
    T.StructField("sunshine_duration", T.DoubleType()),
    T.StructField("temperature_2m_mean", T.DoubleType()),
    T.StructField("precipitation_sum", T.DoubleType()),
    T.StructField("cloud_cover_mean", T.DoubleType()),
])

# One JSON document per country: parallel daily arrays.
WEATHER_JSON = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("wind_speed_10m_max", T.ArrayType(T.DoubleType())),
        T.StructField("sunshine_duration", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
        T.StructField("cloud_cover_mean", T.ArrayType(T.DoubleType())),
    ])),
])

GENERATION_RAW = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("datetime_utc", T.TimestampType()),
    T.StructField("production_type", T.StringType()),
    T.StructField("generation_mwh", T.DoubleType()),
    T.StructField("load_mwh", T.DoubleType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

COUNTRY_REFERENCE = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("capital_city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("population", T.LongType()),
    T.StructField("is_eu_member", T.BooleanType()),
    T.StructField("brell_member_pre2025", T.BooleanType()),
    T.StructField("eu_target_2030_pct", T.DoubleType()),
])

GROUP_MEMBERSHIP = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("group_description", T.StringType()),
])

CROSSWALK = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("country_code_iso3", T.StringType()),
])

# Staging mappings: (source column, staged column, Spark SQL type).
OWID_STAGE = [
    ("iso_code", "country_code_iso3", "string"),
    ("country", "country_name", "string"),
    ("year", "year", "bigint"),
    ("renewables_share_elec", "renewable_share_pct", "double"),
    ("low_carbon_share_elec", "low_carbon_share_pct", "double"),
    ("solar_share_elec", "solar_share_pct", "double"),
    ("wind_share_elec", "wind_share_pct", "double"),
    ("hydro_share_elec", "hydro_share_pct", "double"),
    ("nuclear_share_elec", "nuclear_share_pct", "double"),
    ("fossil_share_elec", "fossil_share_pct", "double"),
    ("solar_electricity", "solar_generation_twh", "double"),
    ("wind_electricity", "wind_generation_twh", "double"),
    ("carbon_intensity_elec", "co2_intensity_gco2_kwh", "double"),
]

WEATHER_STAGE = [
    ("country_code", "country_code", "string"),
    ("date", "date", "date"),
    ("wind_speed_10m_max", "wind_speed_10m_max_kmh", "double"),
    ("sunshine_duration", "sunshine_duration_hrs", "double"),
    ("temperature_2m_mean", "temperature_avg_c", "double"),
    ("precipitation_sum", "precipitation_mm", "double"),
    ("cloud_cover_mean", "cloud_cover_pct", "double"),
]

REFERENCE_STAGE = [
    ("country_code", "country_code", "string"),
    ("country_name", "country_name", "string"),
    ("capital_city", "capital_city", "string"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("population", "population", "bigint"),
    ("is_eu_member", "is_eu_member", "boolean"),
    ("brell_member_pre2025", "brell_member_pre2025", "boolean"),
    ("eu_target_2030_pct", "eu_target_2030_pct", "double"),
]
