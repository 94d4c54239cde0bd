"""Write PLANS.md: the final (post-AQE) physical plan shape of every query.

usage: python tools/plan_report.py [sf_dir]
Each query is executed once (collect), then its formatted plan is read
through ``explain`` and summarised: shuffles, broadcasts, join strategies,
partial window limits, scans (columns read, pushed filters).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera import catalog as C  # noqa: E402
from tessera.plans.adhoc import plan_text  # noqa: E402
from tessera.session import build_session  # noqa: E402


def summarise(plan: str) -> dict[str, str]:
    # AQE prints a final and an initial tree, for the query and for each scalar sub-query
    finals = [t.split("== Initial Plan ==")[0] for t in plan.split("== Final Plan ==")[1:]]
    tree = "\n".join(finals) or plan.split("\n\n")[0]
    count = lambda pat: len(re.findall(pat, tree))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    parts = [p for p in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) if p]
    return {
        "shuffles": str(count(r"\bShuffleQueryStage\b") or (count(r"\bExchange\b") - count(r"BroadcastExchange"))),
        "broadcasts": str(count(r"\bBroadcastQueryStage\b") or count(r"BroadcastExchange")),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                                 r"BroadcastNestedLoopJoin|CartesianProduct)", tree)))) or "–",
        "partial limit": "yes" if re.search(r"WindowGroupLimit.*\n.*\n*.*Partial|Partial", plan) and
                         "WindowGroupLimit" in tree else "–",
        "windows": str(count(r"\bWindow\b")),
        "python": "yes" if re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython", plan) else "no",
        "scans": str(count(r"Scan (parquet|text|json)")),
        "reused": str(count(r"Reused(Exchange|QueryStage)")),
        "scan columns": " · ".join(sorted({str(len(s.split(","))) for s in scans})) or "–",
        "pushed": "; ".join(pushed + [f"partition: {p}" for p in parts])[:80] or "–",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    rows = []
    for name, fn in C.QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        rows.append((name, summarise(plan_text(df, "formatted"))))
    cols = list(rows[0][1])
    out = ["# Physical plans (final, after AQE)", "",
           f"Generated by `tools/plan_report.py` at `{sf}` on `local[8]`. Sink-writing queries show the plan of",
           "the DataFrame they return (the read-back side). Sub-queries count. `shuffles` counts hash/range exchanges,",
           "`scan columns` the columns each parquet scan reads.", "",
           "| query | " + " | ".join(cols) + " |", "|" + "---|" * (len(cols) + 1)]
    for name, s in rows:
        out.append(f"| `{name}` | " + " | ".join(s[c].replace("|", "/") for c in cols) + " |")
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
