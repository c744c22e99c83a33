"""Summarise the physical plan of every registered query: shuffles,
broadcasts, windows (with their partition keys), expands, scans.

    python tools/plan_summary.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    text = df._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", text)
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)
    scans = re.findall(r"(FileScan \w+|Scan \w+|InMemoryTableScan|Scan ExistingRDD|Scan LogicalRDD)", text)
    return {
        "shuffles": len(shuffles),
        "single_partition_shuffles": shuffles.count("SinglePartition"),
        "broadcasts": text.count("BroadcastExchange"),
        "window_partition_keys": [re.sub(r"#\d+L?", "", w) or "(none)" for w in windows],
        "expand": text.count("Expand"),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "broadcast_hash_joins": text.count("BroadcastHashJoin"),
        "nested_loop_or_cartesian": text.count("BroadcastNestedLoopJoin") + text.count("CartesianProduct"),
        "scans": sorted(set(scans)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from aerofeat.plans import catalog
    from aerofeat.session import local_session
    spark = local_session(8)
    for name, fn in catalog.queries().items():
        if only and name not in only:
            continue
        s = summarise(fn(spark, sf))
        print(f"| {name} | {s['shuffles']} | {s['single_partition_shuffles']} | {s['broadcasts']} | "
              f"{'; '.join(s['window_partition_keys']) or '-'} | {s['expand']} | "
              f"{s['sort_merge_joins']}/{s['broadcast_hash_joins']} | {s['nested_loop_or_cartesian']} |")


if __name__ == "__main__":
    main()
