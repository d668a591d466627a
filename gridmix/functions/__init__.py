"""Column-level functions (scalar and aggregate expressions)."""

from gridmix.functions.calendar import (
    as_date, date_parts, days_before, month_num_of, month_start, period, season, utc_day, year_of,
)
from gridmix.functions.classify import classify
from gridmix.functions.numeric import (
    exact, exact_avg, exact_sum, masked_avg, round_half_up, safe_corr, safe_ratio, share_pct,
)
from gridmix.functions.scores import delta, emissions_avoided, resilience, target_gap, target_progress

__all__ = [
    "as_date", "date_parts", "days_before", "month_num_of", "month_start", "period", "season",
    "utc_day", "year_of", "classify", "exact", "exact_avg", "exact_sum", "masked_avg",
    "round_half_up", "safe_corr", "safe_ratio", "share_pct", "delta",
    "emissions_avoided", "resilience", "target_gap", "target_progress",
]
