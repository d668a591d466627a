"""Plan regression tests: the physical plans keep the properties the design relies on."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from gridmix.operators.joins import bounded_broadcast
from gridmix.plans import intermediate as I
from gridmix.plans.registry import queries
from gridmix.streaming.incremental import since
from tests.helpers import hourly

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_no_python_and_no_cartesian_in_any_query(spark):
    bad = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
           "CartesianProduct", "BroadcastNestedLoopJoin")
    for name, build in queries().items():
        text = plan(build(spark, SF))
        assert not [b for b in bad if b in text], name


def test_lookback_pushed_down_and_columns_pruned(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    hourly(spark, [("DE", "2025-01-01 10:00", "Solar", 1, 2)]).withColumn(
        "_loaded_at", F.current_timestamp()).write.parquet(path)
    raw = spark.read.parquet(path)
    text = plan(I.generation_rollup(since(raw, "datetime_utc", dt.date(2025, 1, 1))))
    scan = [line for line in text.splitlines() if line.startswith(("PushedFilters", "ReadSchema"))]
    assert any("GreaterThanOrEqual(datetime_utc" in line for line in scan), scan
    assert all("_loaded_at" not in line for line in scan if line.startswith("ReadSchema"))
    assert text.count("Exchange (") == 1          # one shuffle of the raw rows


def test_bounded_broadcast_falls_back_beyond_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(50).withColumnRenamed("id", "k")
        small = spark.range(5).withColumnRenamed("id", "k")
        assert "BroadcastExchange" not in plan(big.join(bounded_broadcast(big, max_rows=10), "k"))
        assert "BroadcastExchange" in plan(big.join(bounded_broadcast(small, max_rows=10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rollup_pre_aggregates_before_its_shuffle_with_a_hot_key(spark):
    # One country holds half of all rows: the partial aggregate reduces it per
    # task before the only exchange, and the result equals the plain sums.
    rows = [("HOT", f"2025-01-0{1 + i % 3} {i % 24:02d}:00", "Solar", 1, 10) for i in range(300)]
    rows += [(f"C{i % 30}", f"2025-01-0{1 + i % 3} 00:00", "Nuclear", 2, 10) for i in range(300)]
    roll = I.generation_rollup(hourly(spark, rows).repartition(8))
    text = plan(roll)
    tree = text.split("\n\n")[0]
    assert tree.count("HashAggregate") >= 2 and "partial_sum" in text
    hot = {r.date.day: r.generation_mwh for r in roll.filter(F.col("country_code") == "HOT").collect()}
    assert hot == {1: 100.0, 2: 100.0, 3: 100.0}
