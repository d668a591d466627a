"""Staging models: rename, cast to the declared schema, drop rows without keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix import schemas
from gridmix.functions.numeric import round_half_up


def stage(df: DataFrame, mapping: list, not_null: list = (),
          transforms: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """``select cast(src as type) as dst ...`` then keep rows whose ``not_null``
    staged columns are present. ``transforms`` post-processes named outputs."""
    transforms = transforms or {}
    cols = []
    for src, dst, typ in mapping:
        c = F.col(src).cast(typ)
        if dst in transforms:
            c = transforms[dst](c)
        cols.append(c.alias(dst))
    out = df.select(*cols)
    for key in not_null:
        out = out.filter(F.col(key).isNotNull())
    return out


def seconds_to_hours(c: Column, digits: int = 2) -> Column:
    """Unit conversion s -> h, rounded."""
    return round_half_up(c / F.lit(3600), digits)


def stg_annual_stats(raw: DataFrame) -> DataFrame:
    """M1: yearly statistics, 13 typed columns, keys (country_code_iso3, year) present."""
    return stage(raw, schemas.OWID_STAGE, not_null=["country_code_iso3", "year"])


def stg_weather(raw: DataFrame) -> DataFrame:
    """M2: daily weather, sunshine converted to hours, keys (country_code, date) present."""
    return stage(raw, schemas.WEATHER_STAGE, not_null=["country_code", "date"],
                 transforms={"sunshine_duration_hrs": seconds_to_hours})


def stg_country_reference(seed: DataFrame) -> DataFrame:
    """M3: reference seed with declared types."""
    return stage(seed, schemas.REFERENCE_STAGE)
