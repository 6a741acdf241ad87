"""Physical plan shape of every query after execution (adaptive plans final).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from moodcast.plans import catalog  # noqa: E402
from moodcast.plans.workspace import workspace  # noqa: E402
from moodcast.session import build_session  # noqa: E402

COUNTS = [
    ("shuffles", ("Exchange",)),
    ("broadcasts", ("BroadcastExchange",)),
    ("BHJ", ("BroadcastHashJoin",)),
    ("SMJ", ("SortMergeJoin",)),
    ("windows", ("Window",)),
    ("python", ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas")),
    ("cache reads", ("InMemoryTableScan", "TableCacheQueryStage")),
]


def _seq(scala_seq):
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def walk(node, names: list[str]) -> None:
    """Node names of a physical plan: adaptive plans in their final form,
    query stages and subqueries followed, cached inputs not entered."""
    name = node.nodeName()
    names.append(name)
    if name in ("InMemoryTableScan", "TableCacheQueryStage", "ReusedExchange"):
        return
    if name == "AdaptiveSparkPlan":
        walk(node.executedPlan(), names)
        return
    if name.endswith("QueryStage"):
        walk(node.plan(), names)
        return
    for sub in _seq(node.subqueries()):
        walk(sub, names)
    for child in _seq(node.children()):
        walk(child, names)


def plan_counts(df) -> list[int]:
    names: list[str] = []
    walk(df._jdf.queryExecution().executedPlan(), names)
    return [sum(1 for n in names if n in wanted) for _, wanted in COUNTS]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    ws = workspace(spark, sf_dir)
    print(f"# Physical plans at {os.path.basename(sf_dir)}\n")
    print("Counts are taken from each query's executed plan after it ran (adaptive plans in their final")
    print("form, subqueries included), so they show what Spark did on this data, e.g. a join that")
    print("adaptive execution turned into a broadcast. Work done once for a persisted input (weather,")
    print("classified comments, the city x day base, the monthly table, counted broadcast sides) is not")
    print("counted again in the queries that read it; `cache reads` shows how many such inputs a query")
    print("uses. Queries run in catalog order in one session; `sec` includes building persisted inputs")
    print("the first time they are needed.\n")
    print("| query | " + " | ".join(c for c, _ in COUNTS) + " | sec |")
    print("| --- | " + " | ".join("---" for _ in COUNTS) + " | --- |")
    for name, entry in catalog.REGISTRY.items():
        t0 = time.perf_counter()
        df = entry.build(ws)
        df.write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        cells = [str(c) for c in plan_counts(df)]
        print(f"| `{name}` | " + " | ".join(cells) + f" | {secs:.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
