"""Joins: dimension lookup, many-to-many fan-out, crosswalk, size-checked broadcast.

Broadcast is used only behind a size check. Dimension tables (seeds, the
crosswalk, group membership) have a fixed, tiny size; ``bounded_broadcast``
verifies the bound with a cheap ``limit(n + 1).count()`` job and falls back to
a normal shuffle join (and AQE's runtime conversion) when it does not hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.session import session_key

# Largest dimension we are willing to ship to every executor, in rows. The
# dimensions gridmix joins have a few dozen rows; anything larger than this is
# left to the planner.
MAX_BROADCAST_ROWS = 100_000


# Outcome of earlier size checks, keyed by the plan's semantic hash and the
# bound, so a dimension used by several models is counted once per session.
_CHECKED: dict[tuple, bool] = {}


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows."""
    key = (session_key(df.sparkSession), df.semanticHash(), tuple(df.inputFiles()), max_rows)
    small = _CHECKED.get(key)
    if small is None:
        small = df.limit(max_rows + 1).count() <= max_rows
        _CHECKED[key] = small
    return F.broadcast(df) if small else df


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Enrich ``df`` with the columns of a small dimension (left join by default)."""
    return df.join(bounded_broadcast(dim, max_rows), on=on, how=how)


def fan_out(df: DataFrame, membership: DataFrame, on="country_code",
            max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join to a many-to-many membership table: one row per (row, group)."""
    return df.join(bounded_broadcast(membership, max_rows), on=on, how="inner")


def crosswalk(df: DataFrame, xw: DataFrame, from_key: str, to_key: str,
              max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add ``to_key`` translated from ``from_key`` through a code crosswalk (left join)."""
    small = xw.select(F.col(from_key), F.col(to_key)).dropDuplicates([from_key])
    return df.join(bounded_broadcast(small, max_rows), on=from_key, how="left")


def join_detail_to_aggregate(detail: DataFrame, aggregate: DataFrame, on) -> DataFrame:
    """Left-join detail rows back to an aggregate over the same keys (no broadcast hint:
    the aggregate's size grows with the key count, so the planner/AQE decides)."""
    return detail.join(aggregate, on=on, how="left")


def semi_filter(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Keep rows whose key appears in ``keys`` (IN-list given as a table)."""
    return df.join(bounded_broadcast(keys.select(on).distinct() if isinstance(on, str)
                                     else keys.select(*on).distinct()), on=on, how="left_semi")


def matching(df: DataFrame, keys: DataFrame, on: list, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or isn't (``left_anti``) in ``keys``; NULL is
    a key like any other, as it is for a grouping."""
    other = keys.select(*[F.col(k).alias(f"_key_{k}") for k in on])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in on])
    return df.join(other, same, how)
