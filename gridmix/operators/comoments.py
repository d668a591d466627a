"""Correlation from mergeable co-moments.

A state holds, of the rows where x and y are both there: their number n, the
means, and the second moments about the means (of x, of y, and of both). The
state of two disjoint sets of rows comes from their two states alone (pairwise
merge of centred moments), so a correlation over history is kept up to date by
merging the states of new blocks of rows; history isn't read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.functions.numeric import round_half_up, safe_ratio

PARTS = ["n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy"]


def _mean(x: Column) -> Column:
    """Mean of a group; of equal values it is the value itself, to the last digit."""
    return F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.avg(x))


def state(x: str, y: str) -> Column:
    """Aggregate: the state of the rows of a group. Without such rows n is 0 and so is all else."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    n = F.count(xs)
    zero = F.lit(0.0)
    parts = [n, _mean(xs), _mean(ys), F.var_pop(xs) * n, F.var_pop(ys) * n, F.covar_pop(xs, ys) * n]
    return F.struct(*[(p if i == 0 else F.coalesce(p, zero)).alias(name)
                      for i, (p, name) in enumerate(zip(parts, PARTS))])


def merged(a: Column, b: Column) -> Column:
    """The state of the rows of two disjoint states."""
    n = a["n"] + b["n"]
    weight = F.when(n > 0, b["n"] / F.nullif(n, F.lit(0).cast("bigint"))).otherwise(F.lit(0.0))
    dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    # An empty side has no mean to differ from.
    cross = F.when((a["n"] > 0) & (b["n"] > 0), a["n"] * weight).otherwise(F.lit(0.0))

    def mean(name: str, d: Column) -> Column:
        return F.when(a["n"] == 0, b[name]).when(b["n"] == 0, a[name]).otherwise(a[name] + d * weight)

    values = [n, mean("mean_x", dx), mean("mean_y", dy), a["m2_x"] + b["m2_x"] + dx * dx * cross,
              a["m2_y"] + b["m2_y"] + dy * dy * cross, a["c_xy"] + b["c_xy"] + dx * dy * cross]
    return F.struct(*[v.alias(name) for v, name in zip(values, PARTS)])


def merge_states(df: DataFrame, keys: list, order: str, states: list, sums: list = ()) -> DataFrame:
    """One row per key: each of the ``states`` columns merged over its rows in the order of
    ``order``, each of the ``sums`` columns added up.

    A key's rows are its blocks, gathered in one array: blocks must be few (months of a season).
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), *states)))
    start = F.lit(0).cast("bigint")
    empty = F.struct(start.alias("n"), *[F.lit(0.0).alias(p) for p in PARTS[1:]])
    gathered = df.groupBy(*keys).agg(rows.alias("_rows"), *[F.sum(c).alias(c) for c in sums])

    def fold(name: str) -> Column:
        return F.aggregate("_rows", empty, lambda acc, row: merged(acc, row[name])).alias(name)

    return gathered.select(*keys, *[fold(name) for name in states], *sums)


def correlation(s: Column, digits: int | None = 4) -> Column:
    """Pearson correlation of a state; NULL where it is undefined."""
    value = safe_ratio(s["c_xy"], F.sqrt(s["m2_x"]) * F.sqrt(s["m2_y"]))
    return value if digits is None else round_half_up(value, digits)
