"""Every registered query vs its DuckDB oracle on the smallest driver tables.

Same comparison as the driver's correctness gate (column names and types, row count,
order-insensitive values), run at sf0.001 to keep the suite fast;
``tools/oracle_check.py`` runs it at any scale factor.
"""

import os

import pytest

from gridmix.plans.registry import oracle, queries
from tools.oracle_check import compare, duck

SF = os.environ.get("GRIDMIX_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")

SQL = oracle()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_is_registered_with_the_driver():
    import __spark_entry__ as entry
    assert set(queries()) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    # What else there is belongs to the optional subpackage.
    assert all(n == "pipeline" or n.startswith("op") for n in set(entry.queries()) - set(queries()))
    missing = sorted(set(queries()) - set(SQL))
    assert missing == [], f"queries without an oracle: {missing}"


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, n, _, _, detail = compare(spark, con, name, queries()[name], SQL[name], SF)
    assert status == "OK", detail


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    scores = [r["resilience_score"] for r in df.select("resilience_score").collect()]
    assert scores and any(s is not None for s in scores)
