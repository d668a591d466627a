"""Ranks and rolling windows whose parallelism isn't the number of keys.

The windows of ``operators.windows`` hold all rows of a key in one task. That is
right while a key's rows are bounded by the calendar. The operators here give the
same results where one key may hold most of the rows: the rank goes over ranges
of values with running totals, the rolling window over blocks of a series that
get the rows they need from the blocks before them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.constants import ROLLING_ROWS
from gridmix.functions.numeric import round_half_up, safe_ratio
from gridmix.sources.sinks import materialize

#: Distinct values of a rank that one task orders, about.
RANGE_VALUES = 100_000


def _same(left: list, right: list) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def rank_desc_ranges(df: DataFrame, value: str, keys: list, out: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """``windows.rank_desc`` without a task per key: RANK by ``value`` descending, NULLs last, as bigint.

    Rows are counted per (keys, value), which settles ties: the rank of a value is
    1 plus the rows with greater ones. The counted values are put in ranges by
    (keys, value); a value's rows before it are those of its key's ranges before
    and of the values before it in its own range. A task orders one range, whatever
    the size of a key.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(counted, "rank-values")
    ranges = max(1, -(-counted.count() // range_values))
    order = F.col(value).desc_nulls_last()
    placed = counted.withColumn("_range", F.lit(0))
    if ranges > 1:  # the number of a range is written with its values
        placed = materialize(counted.repartitionByRange(ranges, *keys, order)
                             .withColumn("_range", F.spark_partition_id()), "rank-ranges")
    past = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all")).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_in"),
        F.coalesce(F.sum("_all").over(past), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    here = placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranked = here.join(totals, _same([*keys, "_range"], [*[f"_key_{k}" for k in keys], "_in"])).select(
        *[F.col(k).alias(f"_to_{k}") for k in [*keys, value]], (F.col("_base") + F.col("_before") + 1).cast("bigint").alias(out))
    names = [*keys, value]
    return df.join(ranked, _same(names, [f"_to_{k}" for k in names]), "left").select(*df.columns, out)


def with_halo(df: DataFrame, keys: list, order: str, block: Column, rows: int) -> DataFrame:
    """``df`` cut into blocks, each with the ``rows`` rows of its key that come before it.

    ``block`` is a number that doesn't fall along ``order``. Adds ``_block`` and
    ``_halo``: rows of a block itself, and copies of earlier rows (``_halo``), which
    come from as many blocks before it as hold ``rows`` rows. A block sends its last
    ``rows`` rows at most, so copies are few while blocks are much longer.
    """
    cut = df.withColumn("_block", block.cast("bigint"))
    sizes = cut.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    # The blocks after each one, as many as may need rows of it: each has a row at least.
    after = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, max(rows, 1))
    ahead = sizes.withColumn("_after", F.collect_list(F.struct("_block", "_n")).over(after))
    between = F.transform("_after", lambda b, i: F.struct(
        b["_block"].alias("to"), F.aggregate(F.slice("_after", F.lit(1), i), F.lit(0).cast("bigint"),
                                             lambda total, x: total + x["_n"]).alias("between")))
    needing = ahead.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_block").alias("_from"),
                           F.explode(F.filter(between, lambda b: b["between"] < rows)).alias("_need"))
    # Planned as a limit per group before the shuffle.
    last = Window.partitionBy(*keys, "_block").orderBy(F.col(order).desc())
    tails = cut.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= rows)
    copies = tails.join(needing, _same([*keys, "_block"], [*[f"_key_{k}" for k in keys], "_from"])).filter(
        F.col("_back") + F.col("_need.between") <= rows)
    return cut.withColumn("_halo", F.lit(False)).unionByName(
        copies.select(*df.columns, F.col("_need.to").alias("_block"), F.lit(True).alias("_halo")))


def rolling_zscore_blocks(df: DataFrame, values: dict, keys: list, order: str, block: Column,
                          n: int = ROLLING_ROWS, digits: int = 2) -> DataFrame:
    """``windows.rolling_zscore`` of several columns (``{value: name of its z-score}``), a task for each block.

    Every row sees the same ``n`` rows in the same order as with one window per
    key, so the z-scores are the same to the last digit.
    """
    w = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(-(n - 1), 0)
    scores = {out: round_half_up(safe_ratio(F.col(x) - F.avg(x).over(w), F.stddev_samp(x).over(w)), digits)
              for x, out in values.items()}
    scored = with_halo(df, keys, order, block, n - 1).withColumns(scores)
    return scored.filter(~F.col("_halo")).drop("_block", "_halo")


def day_blocks(date_col: str, days: int) -> Column:
    """Blocks of ``days`` calendar days."""
    return F.floor(F.unix_date(F.col(date_col)) / F.lit(days))
