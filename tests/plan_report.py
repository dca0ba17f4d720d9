"""Summarise the physical plans of the registered batch queries.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Runs each query once (so adaptive plans are final) and reports shuffles,
join strategies, top-k/limit operators and what each scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")
OPS = ("WindowGroupLimit", "TakeOrderedAndProject", "Window", "ReusedExchange",
       "ReusedSubquery", "Subquery")


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                          r"RoundRobinPartitioning)", final)
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", final):
        line = m.group(0)
        table = re.search(r"/(\w+)\.parquet", line)
        cols = re.search(r"ReadSchema: struct<([^>]*)>", line)
        # long filter lists are truncated by Spark with "..."
        pushed = re.search(r"PushedFilters: \[(.*?)(?:\]|, ReadSchema)", line)
        scans.append((table.group(1) if table else "?",
                      ",".join(c.split(":")[0] for c in (cols.group(1).split(",")
                                                          if cols and cols.group(1) else [])),
                      pushed.group(1) if pushed else ""))
    return {
        "shuffles": len(shuffles),
        "single": shuffles.count("SinglePartition"),
        "joins": {j: final.count(j) for j in JOINS if j in final},
        "ops": {o: len(re.findall(rf"\b{o}\b", final)) for o in OPS
                if re.search(rf"\b{o}\b", final)},
        "scans": sorted(set(scans)),
    }


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from salestide.session import build_session
    spark = build_session(master="local[8]", shuffle_partitions=16,
                          **{"spark.ui.showConsoleProgress": "false",
                             "spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    from salestide.plans import catalog
    print(f"# Physical plans of the registered batch queries ({os.path.basename(sf_dir)})\n")
    print("Final adaptive plans after one run (`tests/plan_report.py`).  `shuffles` counts")
    print("exchanges (`single` = the final step of a global aggregate); scans list")
    print("the columns read and the filters pushed into the Parquet reader.\n")
    print("| query | shuffles (single) | joins | notable operators | scans: table [columns] {pushed filters} |")
    print("| --- | --- | --- | --- | --- |")
    for name, fn in catalog.QUERIES.items():
        if name.startswith(("s0", "st")):
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        joins = ", ".join(f"{k}×{v}" for k, v in s["joins"].items()) or "—"
        ops = ", ".join(f"{k}×{v}" for k, v in s["ops"].items()) or "—"
        scans = "<br>".join(f"{t} [{c}]" + (f" {{{p}}}" if p else "") for t, c, p in s["scans"])
        print(f"| {name} | {s['shuffles']} ({s['single']}) | {joins} | {ops} | {scans} |")


if __name__ == "__main__":
    main(sys.argv)
