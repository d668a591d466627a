"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts come from ``explain("formatted")`` of the planned (pre-AQE) physical plan:
shuffles, broadcasts, join strategies, windows and aggregates, plus the pushed
filters and read schema of the lineitem scan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "smj": len(re.findall(r"SortMergeJoin", tree)),
        "bhj": len(re.findall(r"BroadcastHashJoin", tree)),
        "windows": len(re.findall(r"\bWindow \(", tree)),
        "hash_aggs": len(re.findall(r"HashAggregate", tree)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", tree)),
        "cartesian": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", tree)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from gridmix.session import get_session
    from gridmix.plans.registry import queries
    spark = get_session(master="local[8]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Planned physical plans of every registered query at `{sf_dir}` "
          "(generated by `tools/plan_summary.py`; AQE may still turn a sort-merge join into a "
          "broadcast at runtime). `shuffles` counts hash/range exchanges. Queries that read the "
          "daily rollup more than once write it first (its one shuffle of the hourly input is "
          "then not part of the plan shown); all others include that shuffle. The raw and seed "
          "stand-ins are landed once per session, so the TPC-H adapter joins do not appear.\n")
    print("| query | shuffles | broadcasts | SMJ | BHJ | windows | hash aggs | python | cartesian |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, build in queries().items():
        s = summary(plan_text(build(spark, sf_dir)))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['windows']} | {s['hash_aggs']} | {s['python']} | {s['cartesian']} |")
    # The one large input: show how the hourly scan is read.
    from gridmix.plans.catalog import Models
    m = Models(spark, sf_dir, materialize=False)
    text = plan_text(m.rollup)
    print("\n## Daily rollup (the only aggregation of the large input)\n")
    print("```")
    print(text.split("\n\n")[0].strip())
    scan = text[text.find("(1) Scan parquet"):]
    print()
    print("\n".join(scan.splitlines()[:6]))
    print("```")


if __name__ == "__main__":
    main()
