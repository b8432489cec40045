"""Physical-plan shape of the headline queries after execution (final AQE plans).

    python tests/plan_report.py [sf_dir]   -> markdown table on stdout
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["clean_trips", "tumbling_flow", "dense_grid", "standardize", "chebyshev_supports", "diffusion_features",
        "forecast_horizon", "anomalies_total", "zone_assign"]


def shape(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", final)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   final)),
        "broadcast joins": final.count("BroadcastHashJoin"),
        "sort-merge joins": final.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "codegen stages": len(set(re.findall(r"\*\((\d+)\)", final))),
        "scans with pushed filters": sum(1 for _, f in scans if f.strip()),
        "scans": len(scans),
    }


def main() -> None:
    import __spark_entry__ as E
    from zoneflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    qs = E.queries()
    rows = []
    for k in KEYS:
        df = qs[k](spark, sf)
        df.collect()  # runs this Dataset's own adaptive plan to its final form (results are small)
        rows.append((k, shape(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(rows[0][1])
    print("| query | " + " | ".join(cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for k, s in rows:
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
