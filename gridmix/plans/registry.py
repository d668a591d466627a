"""Registered queries: ``name -> (spark builder, oracle SQL or None)``.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (through the stand-ins of ``sources.standins``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmix.plans import oracle_sql as O
from gridmix.plans.catalog import Models

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None, reuses_rollup: bool = False):
    """Register a query. ``reuses_rollup`` marks plans that read the daily
    rollup more than once; only those write it to the shared folder first."""
    def deco(fn: Callable[[Models], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Models(spark, sf_dir, share_rollup=reuses_rollup))
        build.__name__ = name
        build.__doc__ = fn.__doc__
        REGISTRY[name] = (build, sql)
        return fn
    return deco


# ---------------------------------------------------------------- models ----

@register("stg_annual_stats", O.model("annual"))
def _stg_annual_stats(m: Models) -> DataFrame:
    """M1 staged yearly statistics."""
    return m.annual


@register("stg_weather", O.model("weather"))
def _stg_weather(m: Models) -> DataFrame:
    """M2 staged daily weather."""
    return m.weather


@register("stg_country_reference", O.model("reference"))
def _stg_country_reference(m: Models) -> DataFrame:
    """M3 staged country reference."""
    return m.reference


@register("int_generation_daily", O.model("daily"))
def _int_generation_daily(m: Models) -> DataFrame:
    """M4 daily generation per category."""
    return m.daily


@register("int_generation_yearly", O.model("yearly"))
def _int_generation_yearly(m: Models) -> DataFrame:
    """M5 yearly generation with annual statistics through the crosswalk."""
    return m.yearly


@register("int_weather_generation", O.model("weather_generation"))
def _int_weather_generation(m: Models) -> DataFrame:
    """M6 daily generation + weather + rolling z-scores + anomaly flags."""
    return m.weather_generation


@register("int_country_profile", O.model("profile"))
def _int_country_profile(m: Models) -> DataFrame:
    """M7 yearly country profile."""
    return m.profile


@register("int_country_group_metrics", O.model("group_metrics"))
def _int_country_group_metrics(m: Models) -> DataFrame:
    """M8 group averages, deltas and ranks."""
    return m.group_metrics


@register("mart_energy_mix", O.model("energy_mix"))
def _mart_energy_mix(m: Models) -> DataFrame:
    """M9 monthly energy mix with YoY growth."""
    return m.energy_mix


@register("mart_weather_correlation", O.model("weather_correlation"))
def _mart_weather_correlation(m: Models) -> DataFrame:
    """M10 daily detail with seasonal correlations."""
    return m.weather_correlation


@register("mart_country_independence", O.model("independence"), reuses_rollup=True)
def _mart_country_independence(m: Models) -> DataFrame:
    """M11 independence days, target progress, CO2 avoided."""
    return m.independence


@register("mart_fossil_dependency", O.model("fossil_dependency"), reuses_rollup=True)
def _mart_fossil_dependency(m: Models) -> DataFrame:
    """M12 monthly fossil exposure with group context."""
    return m.fossil_dependency


@register("mart_resilience_score", O.model("resilience"), reuses_rollup=True)
def _mart_resilience_score(m: Models) -> DataFrame:
    """M13 composite resilience score."""
    return m.resilience


@register("mart_event_story", O.model("event_story"), reuses_rollup=True)
def _mart_event_story(m: Models) -> DataFrame:
    """M14 before/after event study against a baseline group."""
    return m.event_story


def queries() -> dict[str, Builder]:
    # Operator-level queries register themselves on import.
    from gridmix.plans import operator_queries  # noqa: F401
    return {name: b for name, (b, _) in REGISTRY.items()}


def oracle() -> dict[str, str]:
    from gridmix.plans import operator_queries  # noqa: F401
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
