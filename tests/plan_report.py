"""Markdown table of every query's executed (final adaptive) plan: parquet
scans, shuffle exchanges, broadcast exchanges, reused exchanges, join
strategies and top-k operators.

Usage: python tests/plan_report.py [dataset_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def counts(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    pat = {
        "scans": r"FileScan parquet|Scan ExistingRDD|Scan parquet",
        "shuffles": r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
        "broadcasts": r"BroadcastExchange",
        "reused": r"ReusedExchange",
        "smj": r"SortMergeJoin",
        "bhj": r"BroadcastHashJoin",
        "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
        "topk": r"TakeOrderedAndProject|WindowGroupLimit",
    }
    return {k: len(re.findall(v, final)) for k, v in pat.items()}


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries
    from vintage.session import build_session
    spark = build_session("local[8]", 8)
    cols = ["scans", "shuffles", "broadcasts", "reused", "smj", "bhj", "bnlj", "topk"]
    print(f"Final adaptive plans at `{root}` (`local[8]`, 8 shuffle partitions).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for k, q in queries().items():
        if k.startswith("publish_"):
            continue
        df = q(spark, root)
        df.collect()
        c = counts(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{k}` | " + " | ".join(str(c[x]) for x in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
