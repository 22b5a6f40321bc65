"""Execute every registered query and summarize its final (AQE) plan.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per query: shuffle stages, broadcast stages, sort-merge and broadcast hash
joins, window and expand operators, and every file scan with its read
columns and pushed filters. Observations and the base table are built once
first, as in the bench, so their scans read the materialized tables.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from tessera.plans import context as ctx  # noqa: E402
from tessera.plans.queries import REGISTRY  # noqa: E402
from tessera.session import get_session  # noqa: E402


TABLES = (
    "lineitem", "supplier", "part", "nation", "documents", "obs", "base_", "scored", "grain_", "text_triples", "summary_sorted",
    "impute_cells", "impute_means", "years", "reference_range", "files/",
)


def scans(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        loc = line.split("Location:", 1)[1] if "Location:" in line else ""
        name = next((t.rstrip("_") for t in TABLES if f"/{t}" in loc), "?")
        cols = re.search(r"FileScan \w+ \[([^\]]*)\]", line)
        ncols = len(cols.group(1).split(",")) if cols and cols.group(1) else 0
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        pf = pushed.group(1) if pushed else ""
        out.append(f"{name}({ncols} cols{'; ' + pf if pf else ''})")
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    for f in (ctx.base, ctx.scored, ctx.grain, ctx.text_triples):
        f(spark, sf)
    print(f"# Executed plans ({sf.rstrip('/').split('/')[-1]}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`. Shuffle = shuffle query stages actually run;")
    print("SMJ/BHJ = sort-merge / broadcast hash joins in the final plan; scans list the")
    print("file read, the number of columns read and the filters pushed into the scan.")
    print("Small aggregates and files that a query writes before its last plan are read there.\n")
    print("| query | shuffles | broadcasts | SMJ | BHJ | window | expand | scans |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in REGISTRY.items():
        df = fn(spark, sf)
        df.collect()  # runs this DataFrame's own query, so its plan is the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        c = final.count
        print(
            f"| {name} | {c('ShuffleQueryStage')} | {c('BroadcastQueryStage')} | {c('SortMergeJoin')} | "
            f"{c('BroadcastHashJoin')} | {c('Window ')} | {c('Expand ')} | {'<br>'.join(sorted(set(scans(final))))} |"
        )


if __name__ == "__main__":
    main()
