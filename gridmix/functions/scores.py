"""Target progress, emissions and the composite resilience score (Columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmix.constants import CO2_BASELINE_G_KWH, CO2_DIVISOR, RESILIENCE_WEIGHTS
from gridmix.functions.numeric import round_half_up, safe_ratio


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def target_progress(share, target, digits: int = 2) -> Column:
    """``round(share / nullif(target, 0) * 100, 2)``; NULL target -> NULL."""
    return round_half_up(safe_ratio(share, target) * 100, digits)


def target_gap(share, target, digits: int = 2) -> Column:
    """``round(target - share, 2)``; NULL target -> NULL."""
    return round_half_up(_col(target) - _col(share), digits)


def emissions_avoided(intensity, mwh, baseline: float = CO2_BASELINE_G_KWH,
                      divisor: float = CO2_DIVISOR, digits: int = 2) -> Column:
    """``round((baseline - intensity) * mwh / divisor, 2)``.

    (g/kWh) x MWh is kilograms, so with the default divisor the unit is kilotonnes,
    although the output column keeps its historical ``_tonnes`` name.
    """
    return round_half_up((F.lit(baseline) - _col(intensity)) * _col(mwh) / F.lit(divisor), digits)


def delta(a, b, digits: int = 2) -> Column:
    """``round(a - b, 2)``; NULL on either side -> NULL."""
    return round_half_up(_col(a) - _col(b), digits)


def resilience(share, fossil, progress, weights: tuple = RESILIENCE_WEIGHTS,
               digits: int = 2) -> Column:
    """``round(share*w1 + (100 - fossil)*w2 + nullif(progress, 0)*w3, 2)``.

    NULL when any input is NULL or progress is 0; not capped at 100.
    """
    w1, w2, w3 = weights
    return round_half_up(
        (_col(share) * F.lit(w1))
        + ((F.lit(100) - _col(fossil)) * F.lit(w2))
        + (F.nullif(_col(progress), F.lit(0)) * F.lit(w3)),
        digits,
    )
