"""Data-quality checks. Each check returns a DataFrame of violations (0 rows = pass).

``report`` turns a list of checks into one small DataFrame with the failure
count, severity and status of each; ``column_checks`` evaluates many column
checks of one table in a single aggregate pass.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmix.functions.numeric import round_half_up, safe_ratio
from gridmix.operators.sets import gap_runs, grid, missing_keys


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (NULLs are ignored, as in SQL tests)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is outside ``values`` (NULL passes)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def outside(col: str, lo=None, hi=None) -> Column:
    """``col < lo`` or ``col > hi`` (NULL passes)."""
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (F.col(col) < F.lit(lo))
    if hi is not None:
        cond = cond | (F.col(col) > F.lit(hi))
    return cond


def exceeds(numerator: str, denominator: str, factor: float = 1.5) -> Column:
    """``numerator > denominator * factor`` where ``denominator > 0``."""
    return (F.col(numerator) > F.col(denominator) * F.lit(factor)) & (F.col(denominator) > F.lit(0))


def in_range(df: DataFrame, col: str, lo=None, hi=None, select: list | None = None) -> DataFrame:
    """Rows with ``col < lo`` or ``col > hi`` (NULL passes)."""
    out = df.filter(outside(col, lo, hi))
    return out.select(*select) if select else out


def non_negative(df: DataFrame, col: str, select: list | None = None) -> DataFrame:
    return in_range(df, col, lo=0, select=select)


def ratio_above(df: DataFrame, numerator: str, denominator: str, factor: float = 1.5,
                out: str = "generation_to_load_ratio", select: list | None = None,
                digits: int = 2) -> DataFrame:
    """Rows where ``numerator > denominator * factor`` and ``denominator > 0``, with the ratio."""
    flagged = df.filter(exceeds(numerator, denominator, factor))
    cols = select or df.columns
    return flagged.select(*cols, round_half_up(safe_ratio(numerator, denominator), digits).alias(out))


def min_rows(df: DataFrame, keys: list, minimum: int = 4, out: str = "row_count") -> DataFrame:
    """Keys with fewer than ``minimum`` rows (GROUP BY ... HAVING count(*) < minimum)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(out))
            .filter(F.col(out) < F.lit(minimum)))


def date_gaps(df: DataFrame, keys: list, date_col: str = "date",
              out: str = "missing_date") -> DataFrame:
    """Days missing between the first and last date of each key (inner gaps only).

    Only the gaps are expanded to days (``sets.gap_runs``), not the calendar.
    """
    days = F.explode(F.sequence("gap_start", "gap_end"))
    return gap_runs(df, keys, date_col).select(*keys, days.alias(out))


def grid_gaps(df: DataFrame, key_col: str, required: list, other_col: str) -> DataFrame:
    """Required keys x observed values of ``other_col`` that have no row."""
    observed = df.select(other_col).distinct()
    expected = grid(observed, key_col, required)
    return missing_keys(expected, df.select(key_col, other_col), [key_col, other_col])


def coverage_gaps(df: DataFrame, reference: DataFrame, keys: list) -> DataFrame:
    """Distinct keys of ``df`` that have no row in ``reference``."""
    return missing_keys(df.select(*keys), reference, keys).distinct()


def freshness(df: DataFrame, ts_col: str, as_of, warn_days: float, error_days: float,
              keys: list | None = None) -> DataFrame:
    """Age of the newest ``ts_col`` against ``as_of``: status pass / warn / error.

    One row per key (or one row overall) with ``max_loaded_at``, ``age_hours``
    and ``status``. An empty source is an error.
    """
    keys = keys or []
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.replace(tzinfo=None).isoformat(sep=" ")
    # Text literal -> timestamp_ntz: no dependence on the Python process's zone.
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    newest = df.groupBy(*keys).agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_loaded_at"))
    age_s = (F.unix_micros(as_of_col.cast("timestamp")) -
             F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(1_000_000)
    age_h = round_half_up(age_s / F.lit(3600), 2)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age_s > F.lit(error_days * 86400), F.lit("error"))
              .when(age_s > F.lit(warn_days * 86400), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return newest.select(*keys, "max_loaded_at", age_h.alias("age_hours"), status.alias("status"))


@dataclass
class Check:
    name: str
    violations: DataFrame
    severity: str = "error"   # "error" or "warn"


def report(checks: list) -> DataFrame:
    """One row per check: name, severity, failures, status (pass / warn / error)."""
    parts = []
    for check in checks:
        counted = check.violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(counted.select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            "failures",
            F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(check.severity))
            .alias("status"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_report(df: DataFrame, checks: dict[str, tuple[Column, str]]) -> DataFrame:
    """``report`` for checks that are conditions on a row, {name: (violation, severity)}: one pass over ``df``."""
    row = df.agg(*[F.count_if(bad).cast("bigint").alias(f"_{i}") for i, (bad, _) in enumerate(checks.values())])
    stack = F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                 F.col(f"_{i}").alias("failures"))
        for i, (name, (_, severity)) in enumerate(checks.items())]))
    return row.select(stack).withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.col("severity")))


def _column_counts(not_null_cols: list = (), accepted: dict | None = None) -> list[tuple[str, str, Column]]:
    """(check, column, number of failing rows) of the checks that one aggregate can count."""
    exprs = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null_cols]
    for c, values in (accepted or {}).items():
        exprs.append(("accepted_values", c,
                      F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))))
    return exprs


def _counted(row: DataFrame, table: str, exprs: list[tuple[str, str, Column]]) -> DataFrame:
    """(table_name, check_name, column_name, failures) from one row of counts ``_0``, ``_1``, ..."""
    stack = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("check_name"), F.lit(c).alias("column_name"),
                 F.col(f"_{i}").alias("failures"))
        for i, (kind, c, _) in enumerate(exprs)
    ]))
    return row.select(stack).select(F.lit(table).alias("table_name"), "check_name",
                                    "column_name", "failures")


def column_checks(df: DataFrame, table: str, not_null_cols: list = (),
                  accepted: dict | None = None, unique_cols: list = ()) -> DataFrame:
    """Many column checks of one table in one scan.

    ``not_null`` and ``accepted_values`` are folded into a single aggregate of
    ``count_if`` expressions; each ``unique`` check needs its own grouping.
    Returns rows (table_name, check_name, column_name, failures).
    """
    exprs = _column_counts(not_null_cols, accepted)
    out = None
    if exprs:
        row = df.agg(*[e.cast("bigint").alias(f"_{i}") for i, (_, _, e) in enumerate(exprs)])
        out = _counted(row, table, exprs)
    for c in unique_cols:
        dup = unique(df, c).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        part = dup.select(F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"),
                          F.lit(c).alias("column_name"), "failures")
        out = part if out is None else out.unionByName(part)
    return out


class ObservedChecks:
    """Column checks of a table that the job writing it counts (``DataFrame.observe``).

    The counts are made in the writing tasks themselves, after the last shuffle,
    so that a map task that runs again after a lost executor isn't counted twice.
    """

    def __init__(self, table: str, not_null_cols: list = (), accepted: dict | None = None) -> None:
        self.table = table
        self.exprs = _column_counts(not_null_cols, accepted)
        self._observation: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, counted while it is written. Give this frame to the writer as it is."""
        self._observation = Observation()
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *[
            e.cast("bigint").alias(f"_{i}") for i, (_, _, e) in enumerate(self.exprs)])

    def counts(self, spark: SparkSession) -> DataFrame:
        """(table_name, check_name, column_name, failures), as ``column_checks`` gives them; after the write."""
        found = self._observation.get
        rows = [(self.table, kind, c, int(found[f"_{i}"])) for i, (kind, c, _) in enumerate(self.exprs)]
        return spark.createDataFrame(rows, CHECK_COUNTS)

    def by_day(self, df: DataFrame, day: str) -> DataFrame:
        """The counts of each day's rows: (day, table_name, check_name, column_name, failures)."""
        row = df.groupBy(day).agg(*[e.cast("bigint").alias(f"_{i}") for i, (_, _, e) in enumerate(self.exprs)])
        stack = F.inline(F.array(*[
            F.struct(F.lit(self.table).alias("table_name"), F.lit(kind).alias("check_name"),
                     F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures"))
            for i, (kind, c, _) in enumerate(self.exprs)]))
        return row.select(day, stack)


CHECK_COUNTS = "table_name string, check_name string, column_name string, failures bigint"


__all__ = [
    "not_null", "unique", "accepted_values", "outside", "exceeds", "in_range", "non_negative",
    "ratio_above", "min_rows", "date_gaps", "grid_gaps", "coverage_gaps", "freshness", "Check",
    "report", "row_report", "column_checks", "ObservedChecks",
]
