"""Column-level numeric helpers: rounding, guarded ratios, exact sums, shares.

All helpers return ``Column`` expressions built from stock functions, so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding goes through a decimal with 10 fractional digits first: half-up on
# the decimal value, identical across engines, instead of half-even/binary
# artefacts of rounding a double directly.
ROUND_DECIMAL = "decimal(28,10)"
# Measures are summed as whole millionths (of a MWh: watt-hours; ties to even on
# the seventh decimal), so a sum does not depend on the order in which partitions
# are combined and stays a primitive long inside generated code. A long holds
# 9.2e12 units; beyond that ANSI mode raises instead of wrapping.
MEASURE_SCALE = 1_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int = 2) -> Column:
    """``round(x, digits)`` with half-up rounding on the decimal value; NULL stays NULL."""
    return F.round(_col(c).cast(ROUND_DECIMAL), digits).cast("double")


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / nullif(denominator, 0)``: NULL instead of a division error."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def exact(c) -> Column:
    """Measure as a whole number of millionths (bigint). NaN counts as missing (NULL)."""
    x = _col(c).cast("double")
    return F.rint(F.when(~F.isnan(x), x) * F.lit(float(MEASURE_SCALE))).cast("bigint")


def from_exact(total) -> Column:
    """Sum of millionths back to a double measure."""
    return _col(total) / F.lit(float(MEASURE_SCALE))


def exact_sum(c, cond: Column | None = None) -> Column:
    """Order-independent SUM of a measure, returned as double.

    With ``cond`` it is the conditional sum ``sum(case when cond then x else 0 end)``.
    """
    value = exact(c)
    if cond is not None:
        value = F.when(cond, value).otherwise(F.lit(0).cast("bigint"))
    return from_exact(F.sum(value))


def exact_avg(c) -> Column:
    """AVG of a measure from an exact sum and a count of its values."""
    return safe_ratio(from_exact(F.sum(exact(c))), F.count(exact(c)))


def share_pct(value, cond: Column, digits: int = 2) -> Column:
    """Aggregate: ``round(sum(x where cond) / nullif(sum(x), 0) * 100, digits)``."""
    return round_half_up(
        safe_ratio(exact_sum(value, cond), exact_sum(value)) * 100, digits
    )


def masked_avg(value, cond: Column) -> Column:
    """AVG over rows where ``cond`` holds (CASE without ELSE); other rows ignored."""
    return exact_avg(F.when(cond, _col(value)))


def safe_corr(x, y, digits: int | None = 4, window=None) -> Column:
    """Pearson correlation that is NULL when undefined.

    ``covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0)`` over the rows
    where both are non-NULL. Unlike ``corr`` it never divides by zero, which
    ANSI mode would turn into an error for one-pair or constant groups. With
    ``window`` every aggregate is evaluated over that window instead of a group.
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    parts = [F.covar_pop(x, y), F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))]
    if window is not None:
        parts = [p.over(window) for p in parts]
    cov, sx, sy = parts
    value = safe_ratio(cov, sx * sy)
    return value if digits is None else round_half_up(value, digits)
