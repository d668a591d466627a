"""Checks counted by the writing job, gaps and islands, null-safe matching."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmix.operators import quality as Q
from gridmix.operators.joins import matching
from gridmix.operators.sets import gap_runs, island_runs
from gridmix.sources.sinks import write_table
from gridmix.streaming.incremental import checks_path, upsert
from tests.helpers import d, rows

SCHEMA = "k string, date date, cat string"
ROWS = [("a", d("2025-01-01"), "x"), (None, d("2025-01-01"), "y"), ("b", d("2025-01-02"), "?"), ("c", d("2025-01-03"), None)]


def _checks():
    return Q.ObservedChecks("t", ["k", "cat"], {"cat": ["x", "y"]})


def _plain(df):
    return sorted(map(tuple, Q.column_checks(df, "t", ["k", "cat"], {"cat": ["x", "y"]}).collect()))


def test_observed_counts_equal_a_scan(spark, tmp_dir):
    df = spark.createDataFrame(ROWS * 50, SCHEMA)
    for i, (frame, by) in enumerate([(df, None), (df, "date"), (df.limit(0), None), (df.filter("k = 'a'"), "date")]):
        checks = _checks()
        write_table(frame, f"{tmp_dir}/t{i}", partition_by=by, checks=checks)
        assert sorted(map(tuple, checks.counts(spark).collect())) == _plain(frame)


def test_counts_follow_an_upsert(spark, tmp_dir):
    path = f"{tmp_dir}/t"

    def kept():
        return sorted(map(tuple, spark.read.parquet(checks_path(path)).groupBy("table_name", "check_name", "column_name").agg(
            F.sum("failures").alias("failures")).collect()))

    for part in (ROWS, [("b", d("2025-01-02"), "x"), (None, d("2025-01-03"), "z")], [("b", d("2025-01-02"), "x")], [("n", d("2025-02-01"), "x")]):
        upsert(spark, spark.createDataFrame(part, SCHEMA), path, ["k", "date"], checks=_checks())
        assert kept() == _plain(spark.read.parquet(path))


def test_warehouse_checks_scan_no_model_for_columns(spark, tmp_dir, monkeypatch):
    from gridmix.plans import warehouse
    from tests.test_warehouse import _raw

    raw = _raw(spark, f"{tmp_dir}/raw", 8)
    paths = warehouse.build_models(spark, raw, f"{tmp_dir}/out")
    as_of = dt.datetime(2025, 1, 1)
    seen, plain = [], Q.column_checks
    monkeypatch.setattr(warehouse.Q, "column_checks", lambda df, name, *a: seen.append(name) or plain(df, name, *a))
    kept = sorted(map(tuple, warehouse.run_checks(spark, raw, paths, as_of).collect()))
    assert seen == ["stg_owid_energy", "stg_weather_daily", "stg_country_reference"]
    monkeypatch.setattr(warehouse, "checks_path", lambda path: path + "_none")
    assert kept == sorted(map(tuple, warehouse.run_checks(spark, raw, paths, as_of).collect()))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 60)))))
def test_gaps_and_islands(spark, found):
    start = dt.date(2024, 2, 10)
    df = spark.createDataFrame([(k, None if i is None else start + dt.timedelta(days=i)) for k, i in found], "k string, date date")
    gaps, islands = [], []
    for key in {k for k, _ in found}:
        days = sorted({i for k, i in found if k == key and i is not None})
        for a, b in zip(days, days[1:]):
            if b > a + 1:
                gaps.append((key, a + 1, b - 1, b - a - 1))
        runs = []
        for i in days:
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        islands += [(key, a, b, b - a + 1) for a, b in runs]

    def plain(frame):
        return sorted(((r[0], (r[1] - start).days, (r[2] - start).days, r[3]) for r in frame.collect()), key=str)

    assert plain(gap_runs(df, ["k"])) == sorted(gaps, key=str)
    assert plain(island_runs(df, ["k"])) == sorted(islands, key=str)
    days = [(k, a + i) for k, a, _, n in gaps for i in range(n)]
    got = [(r[0], (r[1] - start).days) for r in Q.date_gaps(df, ["k"]).collect()]
    assert sorted(got, key=str) == sorted(days, key=str)


def test_gaps_build_no_calendar(spark):
    df = spark.createDataFrame([("a", d("0001-01-01")), ("a", d("9999-12-31"))], "k string, date date")
    assert rows(gap_runs(df, ["k"]), "days") == [(3652057,)]
    plan = Q.date_gaps(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_matching_takes_null_as_a_key(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, v int")
    keys = spark.createDataFrame([(None, 2), ("b", None), ("b", None)], "k string, v int")
    assert sorted(rows(matching(left, keys, ["k", "v"])), key=str) == [("b", None), (None, 2)]
    assert rows(matching(left, keys, ["k", "v"], "left_anti")) == [("a", 1)]
