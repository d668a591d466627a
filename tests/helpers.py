"""Tiny real-shape fixtures (hand-written rows with the energy schemas)."""

import datetime as dt

from pyspark.sql import types as T

from gridmix import schemas

HOURLY = T.StructType([f for f in schemas.GENERATION_RAW.fields if f.name != "_loaded_at"])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def hourly(spark, rows):
    """rows: (country, 'YYYY-MM-DD HH:MM', production_type, generation, load)."""
    return spark.createDataFrame([(c, ts(t), p, float(g) if g is not None else None,
                                   float(l) if l is not None else None)
                                  for c, t, p, g, l in rows], HOURLY)


def daily(spark, rows):
    """rows: (country, 'YYYY-MM-DD', energy_category, generation, load)."""
    from gridmix.functions.calendar import season
    df = spark.createDataFrame([(c, d(x), cat, float(g), float(l) if l is not None else None)
                                for c, x, cat, g, l in rows],
                               "country_code string, date date, energy_category string, "
                               "generation_mwh double, load_mwh double")
    return df.select("country_code", "date", "energy_category", season("date").alias("season"),
                     "generation_mwh", "load_mwh")


def rows(df, *cols, order=None):
    cols = cols or tuple(df.columns)
    out = df.select(*cols)
    if order:
        out = out.orderBy(*order)
    return [tuple(r) for r in out.collect()]
