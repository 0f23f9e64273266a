"""Summarise the executed physical plan of the headline queries.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is executed (noop sink) so the adaptive plan is final; the report
counts shuffles, broadcasts and join strategies and lists every Parquet scan
with its pruned read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "."))

from bench import HEADLINE  # noqa: E402
from pondlens.plans import registry  # noqa: E402
from pondlens.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans of the headline queries ({os.path.basename(sf)}, after AQE)\n")
    print("| query | shuffles | broadcasts | sort-merge joins | broadcast joins | hash aggs | sort aggs | windows |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    scans = {}
    from pondlens.plans.stages import driver_stages
    frames = [("main_build (K15 plan)", driver_stages(spark, sf).main_plan)]
    frames += [(name, registry.run(spark, sf, name)) for name in HEADLINE]
    for name, df in frames:
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = lambda pat: len(re.findall(pat, plan))
        print(f"| {name} | {c(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition')} | "
              f"{c(r'BroadcastExchange')} | {c(r'SortMergeJoin')} | {c(r'BroadcastHashJoin|BroadcastNestedLoopJoin')} | "
              f"{c(r'HashAggregate')} | {c(r'SortAggregate')} | {c(r'Window \[')} |")
        for line in plan.splitlines():
            if "FileScan parquet" in line:
                cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
                pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
                loc = "main (checkpoint)" if "/pondlens/" in line else re.search(r"/([a-z_]+)\.parquet", line).group(1)
                scans.setdefault(name, set()).add(
                    (loc, re.sub(r"#\d+L?", "", cols.group(1) if cols else ""), pushed.group(1) if pushed else ""))
    print("\nEager statistics (cleaning medians/quartiles, describe quantiles) run as their own jobs while a")
    print("query is built; the counts above cover the returned plan only (`describe_numeric` returns the")
    print("small result table, `main_table` reads the main table written once to the checkpoint folder).")
    print("\n## Parquet scans (columns read, pushed filters)\n")
    for name, ss in scans.items():
        for loc, cols, pushed in sorted(ss):
            print(f"* `{name}` - {loc}: [{cols}]" + (f" pushed: {pushed}" if pushed else ""))


if __name__ == "__main__":
    main()
