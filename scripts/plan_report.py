"""Write PLANS.md: the physical shape of every query of the base library.

Usage: python scripts/plan_report.py [sf_dir]

For each query: the operators of the final physical plan (exchanges, join
strategies, aggregates, windows, generators), and per scan the pushed
filters and the columns read.  Eager steps inside a query (staging writes,
hot-key checks) run as they would in a real call.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import registry  # noqa: E402
from tessera.plans.inspect import plan_text  # noqa: E402
from tessera.session import build_session  # noqa: E402

OPS = (
    "Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
    "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
    "Window", "WindowGroupLimit", "Generate", "TakeOrderedAndProject", "ArrowEvalPython", "BatchEvalPython",
)


def summarize(text: str) -> tuple[str, list[str]]:
    counts = {op: len(re.findall(rf"(?<![A-Za-z]){op}\b", text)) for op in OPS}
    ops = ", ".join(f"{op}×{n}" if n > 1 else op for op, n in counts.items() if n)
    scans = []
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", text):
        fmt, cols, pushed = m.groups()
        scans.append(f"{fmt} cols={len(cols.split(','))} pushed=[{pushed[:120]}]")
    return ops or "(scan only)", scans


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    qs = registry.queries()
    lines = [
        "# PLANS",
        "",
        f"Physical plan shape of every query of the base library at `{sf}` (adaptive plans before execution;",
        "generated by `scripts/plan_report.py`).",
        "",
        "| query | operators | scans (columns read, pushed filters) |",
        "| --- | --- | --- |",
    ]
    for key in sorted(qs):
        ops, scans = summarize(plan_text(qs[key](spark, sf), "simple"))
        lines.append(f"| `{key}` | {ops} | {'<br>'.join(scans) or '-'} |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
