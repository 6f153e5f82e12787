"""Physical-plan audit of every registered query -> markdown on stdout.

Usage: python scripts/plan_audit.py [sf_dir]
Counts file scans, shuffle exchanges, broadcasts, sort-merge joins,
windows and sort aggregates, and flags operators that must not appear
(cartesian / nested-loop joins, Python evaluation).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.plans.registry import QUERIES  # noqa: E402
from shoplens.session import get_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | scans | shuffles | broadcasts | sort-merge joins | windows (group-limited) | sort aggregates | flags |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        if name.startswith("stream_"):
            continue  # streaming queries run to completion when called
        p = q(spark, root)._jdf.queryExecution().executedPlan().toString()
        c = p.count
        shuffles = c("Exchange hashpartitioning") + c("Exchange RoundRobin") + c("Exchange SinglePartition") \
            + c("Exchange rangepartitioning")
        flags = ", ".join(b for b in BAD if b in p) or "-"
        print(f"| `{name}` | {c('FileScan')} | {shuffles} | {c('BroadcastExchange')} | {c('SortMergeJoin')} "
              f"| {c('Window [')} ({c('WindowGroupLimit')}) | {c('SortAggregate')} | {flags} |")
    spark.stop()


if __name__ == "__main__":
    main()
