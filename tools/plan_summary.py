"""Summarise the final (adaptive) physical plan of registered queries.

usage: python tools/plan_summary.py [sf_dir] [key ...] > PLANS.md

Each query is run once (at a small scale factor) so the plan shows the
runtime choices of adaptive execution.  For every query: shuffles
(Exchange), broadcasts, join strategies, Python steps (Arrow-batched),
whole-stage codegen stages, and each Parquet scan's read columns and pushed
filters.  Parts a query cut with a checkpoint while it was built appear as
``Scan ExistingRDD``; question blocks handed to the block scorer as a
broadcast variable do not appear as plan nodes.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from docsift.plans.catalog import queries  # noqa: E402
from docsift.session import local_session  # noqa: E402

NODES = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "MapInPandas", "MapInArrow", "ArrowEvalPython", "Window",
         "WindowGroupLimit", "HashAggregate", "Scan ExistingRDD")


def summarise(plan: str) -> tuple[Counter, list[str]]:
    head = plan.split("\n\n")[0].split("== Initial Plan ==")[0]
    counts = Counter()
    for line in head.splitlines():
        m = re.search(r"[+:-]*\s*([A-Za-z][A-Za-z ]*?)\s*\(\d+\)", line)
        if m:
            name = m.group(1).strip()
            for n in NODES:
                if name == n or name.startswith(n + " "):
                    counts[n] += 1
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)+", plan):
        loc = re.search(r"Location: [^\[]*\[([^\]]*)\]", block)
        name = loc.group(1).rsplit("/", 1)[-1] if loc else "?"
        pf = re.search(r"PushedFilters: (\[[^\n]*\])", block)
        rs = re.search(r"ReadSchema: struct<([^\n]*)>", block)
        cols = ",".join(c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))) if rs else "?"
        scans.append(f"{name}({cols}){' ' + pf.group(1) if pf and pf.group(1) != '[]' else ''}")
    counts["codegen"] = len(set(re.findall(r"\[codegen id : (\d+)\]", plan)))
    return counts, sorted(set(scans))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(queries())
    spark = local_session(app="docsift-plans")
    q = queries()
    print("| query | shuffles | broadcasts | joins | Python steps | window / top-k | codegen stages "
          "| checkpointed inputs | Parquet scans (columns, pushed filters) |")
    print("|---|---|---|---|---|---|---|---|---|")
    for key in keys:
        df = q[key](spark, sf)
        df.collect()  # run it: the summary is of the final adaptive plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        c, scans = summarise(buf.getvalue())
        joins = ", ".join(f"{n}×{c[n]}" for n in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                                  "BroadcastNestedLoopJoin", "CartesianProduct") if c[n])
        py = ", ".join(f"{n}×{c[n]}" for n in ("MapInPandas", "MapInArrow", "ArrowEvalPython") if c[n])
        win = ", ".join(f"{n}×{c[n]}" for n in ("Window", "WindowGroupLimit") if c[n])
        print(f"| `{key}` | {c['Exchange']} | {c['BroadcastExchange']} | {joins or '-'} | {py or '-'} | "
              f"{win or '-'} | {c['codegen']} | {c['Scan ExistingRDD'] or '-'} | {'; '.join(scans) or '-'} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
